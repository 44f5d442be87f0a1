"""DuckDB SQL over the same tables, for the queries that SQL can express on whole tables."""

ORACLES: dict[str, str] = {}

ORACLES["op1_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, octet_length(encode(payload)) AS n, sha1(payload) AS digest FROM p),
w AS (SELECT page_id, n, digest, max(page_id) OVER (PARTITION BY digest, n) AS winner FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> winner THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> winner THEN winner END AS refers_to
FROM w
"""

ORACLES["op9_url_filter"] = """
WITH r(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, coalesce(rest, '') AS rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw FROM a),
c AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b),
m AS (SELECT page_id, host, path, h || p AS rule, v FROM c JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)),
best AS (SELECT page_id, rule, v FROM m QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, rule DESC) = 1)
SELECT c.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM c LEFT JOIN best USING (page_id)
"""

# Links by exact counts of common shingles; groups by the smallest id that links lead to.
ORACLES["op3_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS gram FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_common FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
half AS (SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE n_common >= 0.8 * (a.n + b.n - n_common) - 1e-9),
link AS (SELECT x, y FROM half UNION ALL SELECT y, x FROM half),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, link.y FROM reach JOIN link ON reach.other = link.x),
grp AS (SELECT doc_id, min(other) AS class_id FROM reach GROUP BY doc_id),
cop AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY array_to_string(words, ' ')) END AS copy_id,
  CASE WHEN len(words) = 0 THEN 1 ELSE count(*) OVER (PARTITION BY array_to_string(words, ' ')) END AS n_copies FROM w),
cnt AS (SELECT x AS doc_id, count(*) AS n_links FROM link GROUP BY x)
SELECT doc_id, class_id, copy_id, n_copies, coalesce(n_links, 0) AS n_links FROM grp JOIN cop USING (doc_id) LEFT JOIN cnt USING (doc_id)
"""

# What SQL can say of a part of a contract: the sizes and targets of the mix, the base counts, the base spans.

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES["mix_targets"] = f"""
WITH d AS (SELECT doc_id, source, len({_WORDS}) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
k AS (SELECT *, ([1, 2, 3])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, 3.0 * source_size AS cap FROM s),
o AS (SELECT *, row_number() OVER r AS j, sum(source_size) OVER () - coalesce(sum(cap) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(w) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM k WINDOW r AS (ORDER BY cap / w, source NULLS LAST)),
l AS (SELECT arg_min(rest / weights, j) AS water FROM o WHERE rest / weights <= cap / w)
SELECT doc_id, size, source_size, round(least(cap, water * w), 3) AS target FROM d JOIN o ON d.source IS NOT DISTINCT FROM o.source, l
"""

ORACLES["quality_counts"] = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
g AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS win FROM (SELECT doc_id, words, unnest(range(1, greatest(1, len(words) - 6))) AS i FROM w)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^ 	-
]') GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(l.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(words) < 20 OR 100 * coalesce(c.n, 0) > 30 * len(words) AS base_failed
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN l USING (doc_id)
"""


#: A private-use character that marks matches; the operator reads texts that hold it as if it were another one.
_MARK, _FREE = "\ue001", "\ue003"


def _spans(kind: int, name: str, pattern: str, least: int, groups: int) -> str:
    """Matches of a pattern, parted from the rest by marks; lengths of the parts are summed."""
    marked = _MARK + "".join(f"\\{g}{_MARK}" for g in range(1, groups + 1))
    head = "length(before)" if groups == 2 else "0"
    return f"""
SELECT doc_id, {kind} AS k, s, '{name}:' || s || ':' || e AS span FROM (
  SELECT doc_id, begun - {head} AS s, begun + length(part) AS e, length(part) AS n FROM (
    SELECT doc_id, i, part, lag(part) OVER x AS before, coalesce(sum(length(part)) OVER (x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begun FROM (
      SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM (SELECT doc_id, string_split(regexp_replace(text, '{pattern}', '{marked}', 'g'), '{_MARK}') AS parts FROM t))
    WINDOW x AS (PARTITION BY doc_id ORDER BY i)) WHERE i % {groups + 1} = 0) WHERE n >= {least}"""


ORACLES["secret_spans"] = (
    f"WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{_MARK}', '{_FREE}') AS text FROM documents), f AS ("
    + " UNION ALL ".join(
        [
            _spans(0, "assign", r"""((?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?)([A-Za-z0-9+/_.=-]+)""", 8, 2),
            _spans(1, "access", "(AKIA[A-Z0-9]+)", 16, 1),
            _spans(2, "hex", "([0-9a-f]+)", 32, 1),
        ]
    )
    + """)
SELECT t.doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex, sha256(coalesce(string_agg(span, ',' ORDER BY s, k), '')) AS base_sha256
FROM t LEFT JOIN f ON t.doc_id = f.doc_id GROUP BY t.doc_id
"""
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Control strings of the chat template, with what escaping has put behind their first characters.
_CONTROL = r"<\\*s>|<\\*/s>|\[\\*/?INST\]|\[\\*/?SYS\]|\[\\*/?ROLE\]|\[\\*TEXT\]|\[\\*REPLY\]"

ORACLES["op12_chat_format"] = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (SELECT *, length(text) + len(regexp_extract_all(text, '{_CONTROL}')) + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 11 WHEN 'system' THEN 11 ELSE 19 + length(role) + len(regexp_extract_all(role, '{_CONTROL}')) END AS n FROM t),
g AS (SELECT conv_id, count(*)::BIGINT AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss, sum(n)::BIGINT + 3 AS formatted_chars FROM s GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""

ORACLES["op11_collocations"] = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM documents),
o AS (SELECT lang, unnest(ws) AS phrase, 1 AS k FROM p
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])), 2 FROM p WHERE len(ws) > 1
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])), 3 FROM p WHERE len(ws) > 2),
g AS (SELECT lang, phrase, k, count(*) AS a FROM o GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM g WHERE k > 1),
cuts AS (SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS x, array_to_string(w[cut + 1:k], ' ') AS y FROM c, range(1, 3) t(cut) WHERE cut < k),
s AS (SELECT cuts.lang, cuts.phrase, cuts.a, cut, x.a AS l, y.a AS r, (1000000::HUGEINT * cuts.a * cuts.a) // (x.a::HUGEINT * y.a) AS score FROM cuts JOIN g x ON cuts.lang = x.lang AND cuts.x = x.phrase JOIN g y ON cuts.lang = y.lang AND cuts.y = y.phrase),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (SELECT lang, part, max(a) AS a FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM c WHERE k = 3) GROUP BY lang, part),
kept AS (SELECT low.* FROM low LEFT JOIN longer ON low.lang = longer.lang AND low.phrase = longer.part WHERE NOT coalesce(100 * longer.a >= 50 * low.a, false)),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM p GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score::BIGINT AS score FROM kept JOIN n USING (lang)
QUALIFY rank <= 2000
"""

_FEATURES = r"""SELECT doc_id, unnest(ws) AS f FROM {0} UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM {0} WHERE len(ws) > 1"""
_TOKENS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# The crc32 of each distinct feature, byte by byte over a table.
ORACLES["op13_importance_resampling"] = rf"""
WITH tab AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
d AS (SELECT doc_id, {_TOKENS} AS ws FROM documents), b AS (SELECT 0 AS doc_id, {_TOKENS} AS ws FROM benchmark),
fd AS ({_FEATURES.format("d")}), fb AS ({_FEATURES.format("b")}),
hexed AS (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM fd UNION SELECT f FROM fb)),
bytes AS (SELECT f, list_transform(range(1, length(x), 2), lambda i: (instr('0123456789ABCDEF', x[i]) - 1) * 16 + instr('0123456789ABCDEF', x[i + 1]) - 1) AS v FROM hexed),
h AS (SELECT f, xor(list_reduce(list_prepend(4294967295, v), lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, tab),
s AS (SELECT bucket, count(*) AS n FROM fd JOIN h USING (f) GROUP BY bucket), t AS (SELECT bucket, count(*) AS n FROM fb JOIN h USING (f) GROUP BY bucket),
g AS (SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM fd) + 10000) / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM fb) + 10000))))::BIGINT AS gain FROM s LEFT JOIN t ON s.bucket = t.bucket),
w AS (SELECT doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM fd JOIN h USING (f) JOIN g USING (bucket) GROUP BY doc_id),
k AS (SELECT d.doc_id, len(ws) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, substr(sha256('7:' || d.doc_id), 1, 8) AS x FROM d LEFT JOIN w ON d.doc_id = w.doc_id),
u AS (SELECT *, list_sum(list_transform(range(1, 9), lambda i: (instr('0123456789abcdef', x[i]) - 1) * (1::BIGINT << (4 * (8 - i)))))::BIGINT AS z FROM k),
v AS (SELECT *, weight + floor(-1000 * ln(-ln((z + 0.5) / 4294967296)))::BIGINT AS score FROM u),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM v WHERE n_words >= 20)
SELECT v.doc_id, n_features, weight, score, CASE WHEN rank <= 25 * (SELECT count(*) FROM r) // 100 THEN rank END AS rank FROM v LEFT JOIN r ON v.doc_id = r.doc_id
"""
