"""Phrases, chat templates and resampling: brute force, round trips and edge cases."""

import hashlib
import math
import os
import random
import re
import time
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marlstone.llm import chat, common, decontaminate, phrases, pii, resample, secrets, templates

EXTRA = ", n long, rank int, key int, row long, id long, own long, score double, word string"


def table(spark, rows, schema):
    """A table with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6, 0.5, "w") for r in rows], schema + EXTRA)


# 11


def mined(rows, least, most, inside):
    """What `collocations` should give, by dictionaries."""
    out = []
    for lang in {"und" if lang is None else lang for lang, _ in rows}:
        f, n = Counter(), 0
        for own, text in rows:
            if ("und" if own is None else own) != lang:
                continue
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
                w = re.findall(r"[^\x20\x09]+", piece)
                n += len(w)
                f.update(tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
        found = [p for p, a in f.items() if len(p) > 1 and a >= least]
        rows_out = []
        for p in found:
            a = f[p]
            if any(len(q) > len(p) and 100 * f[q] >= inside * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q in found):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows_out.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(rows_out)[:most])]
    return sorted(out)


@pytest.mark.parametrize("broadcast_words", [phrases.BROADCAST_WORDS, 0])
def test_phrases_against_dictionaries(spark, broadcast_words):
    rng = random.Random(3)
    words = "a b c D é the The of x1 longword".split()
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", "!", "\r"]) for _ in range(n))
    rows = [(rng.choice(["en", "fr", None, ""]), text(rng.randint(0, 40))) for _ in range(60)] + [("en", None), ("en", ""), (None, " . "), ("de", "z " * 30000), ("en", "same row"), ("en", "same row"), ("en", "y" * 200_000)]
    docs = table(spark, rows, "lang string, text string")
    for least, most, inside in ((2, 10_000, 50), (5, 7, 90)):
        got = [tuple(r) for r in phrases.collocations(docs, least, most, inside, broadcast_words).collect()]
        assert sorted(got) == mined(rows, least, most, inside)
    assert phrases.collocations(docs.limit(0), broadcast_words=broadcast_words).count() == 0


def test_words_that_are_not_broadcast(spark):
    """A dictionary of which a part is broadcast: the same phrases, and only those with a word of the rest are written to be looked up."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(12)] * 400 + [f"rare{k}" for k in range(60)] + [f"once{k}" for k in range(200)]
    rows = [("en", " ".join(rng.choice(words) for _ in range(60)) + rng.choice([" rare1 rare2 rare3", " w1 rare4 w2.", ""])) for _ in range(300)] + [("fr", "rare1 rare2 w1 " * 5)] * 3
    docs = spark.createDataFrame(rows, "lang string, text string")
    want = mined(rows, 4, 10_000, 50)
    assert any("rare" in r[2] for r in want)
    for broadcast_words in (20, 40):
        folder = common.shared_dir(spark).removeprefix("file://") + "/marlstone"
        os.makedirs(folder, exist_ok=True)
        before = set(os.listdir(folder))
        assert sorted(tuple(r) for r in phrases.collocations(docs, 4, 10_000, 50, broadcast_words).collect()) == want
        made = {d for d in set(os.listdir(folder)) - before if d[:5] not in ("words", "dicti", "local")}
        rows_made = sum(spark.read.parquet(f"{folder}/{d}").count() for d in made)
        assert rows_made < 0.6 * sum(len(t.split()) for _, t in rows)  # not a row for each word


def test_scores_are_exact(spark):
    rows = [(10**14 + k, 3 * 10**14 + 7 * k, 10**14 + 1 + k) for k in range(50)] + [(7, 7, 7), (1, 10**9, 10**9)]
    got = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", phrases.score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert all(r["s"] == 10**6 * r["a"] ** 2 // (r["l"] * r["r"]) for r in got)


def test_hash_table_finds_what_is_in_it():
    import numpy as np

    h1 = np.array([5, 5, 21, 37, 2**63, 6], np.uint64)  # shared hashes and shared places
    h2 = np.array([1, 2, 1, 1, 1, 1], np.uint64)
    at = phrases.hash_table(h1, h2, np.arange(1, 7, dtype=np.uint32))
    assert list(phrases.look_up(at, h1, h2)) == [1, 2, 3, 4, 5, 6]
    assert list(phrases.look_up(at, np.array([5, 7], np.uint64), np.array([3, 1], np.uint64))) == [0, 0]
    n, langs = np.array([50, 1, 1, 900, *[100] * 20]), np.array(["a", "a", "a", *["b"] * 21])
    ends = phrases.range_ends(n, langs, 30)
    assert len(ends) == 29 and (np.diff(ends.astype(float)) >= 0).all() and sum(e >> np.uint64(32) == 4 for e in ends) >= 8 and len(set(ends.tolist())) > 20


# 12


def test_templates_are_folded_and_sandboxed():
    t = templates.compile_template("{{ 'a' ~ 'b' }}c{% if 1 == 2 %}no{% elif not false %}{{ 'd' | upper }}{% endif %}{# x #}{% for m in messages %} {{- m.role ~ loop.index0 }}{% endfor %}", {})
    assert t.tree[0] == ("text", ("const", "abcD")) and [n[0] for n in t.tree] == ["text", "for"]
    out = templates.Output()
    t.turn(templates.Turn("user", "hi", True, True, 4), out)
    assert out.pieces == ["user4"]
    for bad in ("{{ m.text }}", "{% for m in messages %}{{ m.__class__ }}{% endfor %}", "{{ x }}", "{{ open('f') }}", "{{ 'a' | eval }}", "{% for m in rows %}{% endfor %}", "{% if true %}", "{% generation %}", "{{ 'a' }", "{{ 1 + }}", "{% include 'x' %}", "{% for m in messages %}{% for n in messages %}{% endfor %}{% endfor %}"):
        with pytest.raises(templates.TemplateError):
            compiled = templates.compile_template(bad, {})
            raise AssertionError(compiled.tree)


def test_escapes_can_be_undone():
    escape, undo = templates.escaper(chat.CONTROLS)
    rng = random.Random(1)
    for _ in range(3000):
        s = "".join(rng.choice(["<", "/", "s>", "\\", "[INST]", "</s>", "<s>", "[", "/INST]", "x", "\n", "[\\INST]", "<\\\\s>"]) for _ in range(rng.randint(0, 12)))
        e = escape(s)
        assert undo(e) == s and not any(c in e for c in chat.CONTROLS)
    assert escape("plain [text] < 3 \\ n") == "plain [text] < 3 \\ n"


CHATS = [
    *((1, t, r, x) for t, r, x in ((0, "system", "be [INST] kind"), (2, "assistant", "</s>\\"), (1, "user", "a\nb"), (3, "tool", "[/ROLE][TEXT]"), (4, "[TEXT]", None), (5, None, ""))),
    *((2, 0, "user", "tie"), (2, 0, "assistant", "tie"), (2, 0, "user", "tie"), (2, None, "assistant", "last")),
    *((None, 1, "assistant", "no conversation"), (None, 0, "user", None)),
    *((3, t, ["user", "assistant"][t % 2], f"turn {t} <s>") for t in range(1500)),
    (4, 0, "assistant", "long " * 200_000), (5, 10**9, "assistant", "late"), (5, -(10**9), "user", "early"),
]


@pytest.mark.parametrize(("stretch", "segment"), [(chat.TURNS, chat.SEGMENT), (7, 1 << 20), (100, 300), (1, 1)])
def test_chats_come_back(spark, stretch, segment):
    rows = table(spark, CHATS, "conv_id long, turn long, role string, text string").repartition(5)
    segments = chat.render(rows, turns_a_stretch=stretch, segment=segment).persist()
    got = {r["conv_id"]: r for r in chat.digests(segments).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    inf = 10**18
    for conv in {c for c, *_ in CHATS}:
        turns = sorted(((inf if t is None else t, r is None, r or "", x is None, x or "") for c, t, r, x in CHATS if c == conv))
        loss = "".join(x for _, _, r, _, x in turns if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (len(turns), sha("".join(f"{a}\n{b}\n" for _, _, a, _, b in turns)), len(loss), sha(loss)), conv
        whole = "".join(s["formatted"] for s in segments.where(F.col("conv_id").eqNullSafe(F.lit(conv))).orderBy("place").collect()) if conv != 3 else None
        assert whole is None or (len(whole) == r["formatted_chars"] and whole.startswith("<s>") and whole.count("<s>") == 1)
    assert len(got) == len({c for c, *_ in CHATS}) and chat.digests(chat.render(rows.limit(0))).count() == 0


def test_chat_loops_know_their_place(spark):
    rows = spark.createDataFrame([(1, t, "user", "x") for t in range(9)], "conv_id long, turn long, role string, text string")
    source = "{% for m in messages %}{% if loop.first %}<{% endif %}{{ loop.index0 }}{% if loop.last %}>{% endif %}{% endfor %}|"
    for stretch in (100, 2):
        got = chat.render(rows, source, {}, (), turns_a_stretch=stretch).orderBy("place").collect()
        assert "".join(r["formatted"] for r in got) == "<012345678>|"


# 13


def drawn(rows, target, n=2, percent=25, least=20):
    words = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
    bag = lambda w: [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in range(1, n + 1) for i in range(len(w) - k + 1)]
    split = [(i, words(x)) for i, x in rows]
    s, t = Counter(b for _, w in split for b in bag(w)), Counter(b for x in target for b in bag(words(x)))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000)))) for b in range(10000)]
    out = []
    for i, w in split:
        f = bag(w)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    enough = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    top = Counter(enough[: len(enough) * percent // 100])
    return out, top


@pytest.mark.parametrize(("n", "chunk"), [(2, resample.CHUNK), (2, 50), (3, 17), (1, 1)])
def test_resampling_against_a_dictionary(spark, n, chunk):
    rng = random.Random(9)
    vocabulary = ["Word", "été", "ÀB", "x9", "a-b", "日本", "end.", "\x7f", "z" * 60]
    rows = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for k in range(80)]
    rows += [(None, "a null id " * 9), (None, "a null id " * 9), (81, None), (82, ""), (83, " .,"), (84, "twice the same " * 8), (84, "twice the same " * 8), (85, "long words " * 9000), (86, "y" * 100_000)]
    target = ["word x9 end", None, "", "日本 " * 40]
    docs = table(spark, rows, "doc_id long, text string").drop("score", "rank")
    weighed = resample.weigh(docs, spark.createDataFrame([(x,) for x in target], "text string"), n, chunk=chunk)
    got = resample.draw(weighed).collect()
    want, top = drawn(rows, target, n)
    assert Counter((r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"]) for r in got) == Counter(want)
    chosen = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in chosen] == list(range(1, len(chosen) + 1)) and all((a["score"], b["doc_id"] or 10**9) >= (b["score"], a["doc_id"] or 10**9) for a, b in zip(chosen, chosen[1:], strict=False))
    assert Counter((r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"]) for r in chosen) == top


def test_resampling_of_nothing(spark):
    docs = spark.createDataFrame([(1, "some words " * 20)], "doc_id long, text string")
    none = spark.createDataFrame([], "text string")
    assert resample.resample(docs.limit(0), none).count() == 0
    assert [r["n_features"] for r in resample.resample(docs, none).collect()] == [79]


# Earlier operators


def test_full_forms_are_permuted(spark):
    ips = [f"192.168.{a}.{b}" for a in range(256) for b in range(256)]
    mails = [f"{a}@{b}.co" for a in "0123456789" for b in "0123456789"]
    rows = [(k, " ".join(ips[256 * k : 256 * k + 256])) for k in range(256)] + [(256, " ".join(mails)), (257, "far@away.org 10.1.2.3 +49 30 1234567")]
    out = {r["doc_id"]: r["text"].split() for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    got = [x for k in range(256) for x in out[k]]
    assert sorted(got) == sorted(ips) and all(a != b for a, b in zip(got, ips, strict=True))
    assert sorted(out[256]) == sorted(mails) and all(a != b for a, b in zip(out[256], mails, strict=True))
    assert out[257][0] != "far@away.org" and out[257][1].startswith("10.")


def test_rounds_of_draws_end(spark):
    mails = [f"{a}@{b}.co" for a in "abcdef" for b in "01"]
    docs = spark.createDataFrame([(1, " ".join(mails))], "doc_id long, text string")
    now = pii.assign(docs, "k", rounds=0).collect()
    assert len({r["surrogate"] for r in now}) == len(mails)
    assert pii.pseudonymise(docs.limit(0), "k").count() == 0


def test_items_without_an_id_are_found(spark):
    item = "seven brave old sailors carried a wooden chest over the narrow bridge before dawn"
    docs = spark.createDataFrame([(1, f"so {item} and more"), (2, "nothing of the kind")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, item), (None, item), (3, "a different item with some other words in it")], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()] == [(1, None)]
    assert [r["doc_id"] for r in decontaminate.clean(docs, bench).collect()] == [2]


def test_many_secrets_in_one_text(spark):
    rng = random.Random(1)
    dump = lambda n: " ".join(f"{rng.getrandbits(128):032x}" for _ in range(n))
    took = {}
    for n in (300, 2000, 20_000):
        docs, began = spark.createDataFrame([(1, dump(n))], "doc_id long, text string"), time.perf_counter()
        r = secrets.digest(secrets.scan(docs)).first()
        took[n] = time.perf_counter() - began
        assert r["n_hex"] == n and r["spans"].split(",")[-1] == f"hex:{33 * (n - 1)}:{33 * n - 1}"
    assert took[20_000] < 15 * max(took[2000], 1)
    assert common.SALTS > 0
