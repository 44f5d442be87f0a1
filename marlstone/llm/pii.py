"""Surrogates for personal data: keyed, of the same type and format, consistent over the corpus and distinct.

Entities: e-mail addresses, phone numbers, payment card numbers, IPv4 addresses, national numbers of the form
ddd-dd-dddd, and person names: titles or a listed given name, then further given names, initials, particles and up to
two surnames (up to four names after a title), with hyphens and apostrophes. Where a text has a name, its words are
found standing alone, too.

A surrogate is drawn from HMAC-SHA256(key, type, entity, attempt):
* digits become digits in place (separators, leading + and country code stay); a card number keeps its first digit,
  and passes the Luhn check where the original does; IPv4 octets stay in range and private networks private;
* e-mail: letters and digits of each part become such in place, with case; the last label of the domain stays;
* names are replaced word by word, so all mentions of a person agree: `Mary Smith`, `Mrs Smith` and a later `Smith` have
  one surname. A given name becomes another of the same gender and script by a keyed permutation of the list, an
  initial another initial; any other word is a surname, spelt anew from syllables of its script. Titles, particles
  (`van`, `O'`), signs and case stay.

One entity (whatever its spacing or case) has one surrogate everywhere: coreference holds. Collision checks: over all
distinct entities of the corpus (of names: surnames, for permutations are distinct anyway), an entity whose surrogate
another one has (the one of the fewest attempts keeps it, of these the smallest), or that equals some original, is drawn
again until none is left, in at most MOST_ROUNDS rounds. Only entities with a later attempt are exceptions; the rest
follows from the key. Exceptions are broadcast up to BROADCAST_EXCEPTIONS rows; beyond, they reach documents by a join.

Some forms have few values: `192.168.x.y` has 65,536, an e-mail address of one letter before the sign and one behind it
676. Where the corpus holds more than a quarter of a form's values (or rounds run out), draws are no way to tell
entities apart, so the whole form is permuted: each value becomes the one behind it in a keyed order of all values of the form.
Surrogates are then distinct and never the entity's own value, but may be the value of another entity, which can't be
avoided where all values occur. A form of a single value keeps it.

Null texts stay null, empty ones empty, very long ones are read whole. Repeated rows are replaced alike; doc_ids play no
part. Extra columns stay whatever their names are (a column `pii` is replaced). An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_path, new_path, salted_join, unused, written

BROADCAST_EXCEPTIONS = 100_000
#: Distinct entities that a task remembers before it sends them on.
REMEMBERED = 50_000
#: Rounds of draws, and the attempt that stands for a permuted form.
MOST_ROUNDS, PERMUTED = 64, -1
#: The production key is a parameter; this one is for tests and the registered query.
TEST_KEY = "marlstone-test-key"

#: Given names by script and gender.
GIVEN = {
    ("latin", "m"): "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Mark Paul Andrew George Peter Henry Edward Frank Hans Klaus Stefan Jürgen Wolfgang Heinz Jean Pierre Luc Jacques Michel Louis Carlos Juan Miguel Pablo José Luis Javier Antonio Giovanni Marco Luca Paolo Jan Piotr".split(),
    ("latin", "f"): "Mary Linda Susan Karen Sarah Emma Laura Anna Ann Anne Alice Helen Patricia Jennifer Elizabeth Barbara Jessica Margaret Lisa Nancy Ingrid Sabine Petra Monika Ursula Heike Marie Claire Sophie Camille Isabelle Julie Maria María Carmen Lucia Lucía Elena Isabel Ana Giulia Chiara Francesca Katarzyna".split(),
    ("cyrillic", "m"): "Иван Пётр Сергей Андрей Алексей Дмитрий Николай Михаил Владимир Александр Юрий Олег".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Татьяна Наталья Ирина Светлана Екатерина Людмила".split(),
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης Παύλος Βασίλης".split(),
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Σοφία Άννα Δήμητρα Βασιλική".split(),
}
#: Titles, and words between names that are parts of them.
TITLES = "Mr Mrs Ms Miss Mx Dr Prof Professor Sir Herr Frau Monsieur Madame Mme Mlle Señor Señora Sr Sra Don Doña Signor Signora".split()
PARTICLES = "van von de der den del della di da dos du la le al bin ibn zu zur ter ten y".split()
SYLLABLES = {
    "latin": [c + v for c in "bdfgklmnprstvz" for v in "aeiou"],
    "cyrillic": [c + v for c in "бвгдзклмнпрст" for v in "аеиоу"],
    "greek": [c + v for c in "βγδζκλμνπρστ" for v in "αειου"],
}
INITIALS = ["abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνξοπρστυφχψω"]
CAPITAL = {"latin": "[A-ZÀ-ÖØ-Þ]", "cyrillic": "[А-ЯЁ]", "greek": "[Α-ΩΆ-Ώ]"}
SMALL = {"latin": "[A-Za-zÀ-ÖØ-öø-ÿ]", "cyrillic": "[А-Яа-яЁё]", "greek": "[Α-Ωα-ωΆ-ώ]"}

GAP = r"[^\S\n]+"


def _either(words: list[str]) -> str:
    return "|".join(sorted({*words, *(w.upper() for w in words)}, key=lambda w: (-len(w), w)))


def _name(script: str) -> str:
    """Names of one script: with titles, or with a listed given name first."""
    big, small = CAPITAL[script], SMALL[script]
    word = rf"(?:{big}['’])?{big}{small}+(?:-{small}+|['’](?!s\b){small}+)*"
    loose = rf"(?:(?:{big}\.|{big}(?={GAP})|{'|'.join(PARTICLES)}){GAP})"
    given = rf"(?:{_either([n for (s, _), names in GIVEN.items() if s == script for n in names])})(?:-{big}{small}+)?(?![\w'’])"
    titled = rf"(?:(?:{_either(TITLES)})\.?{GAP})+{loose}*{word}(?:{GAP}{loose}*{word}){{0,3}}"
    return rf"{titled}|{given}(?:{GAP}{given})*(?:{GAP}{loose}*{word}){{1,2}}"


#: Patterns in order of precedence, and what a text must hold for each to be tried. An address may begin after a sign,
#: or where another one ends: at an underscore or a digit.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9_])|(?=_)|(?<=[A-Za-z])(?=[0-9]))(?P<email>[A-Za-z0-9_][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})",
    "digits": r"""(?<![\w.])(?P<ip>(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3})(?![\w]|\.\d)
    |(?<![\w-])(?P<national>\d{3}-\d{2}-\d{4})(?![\w-])
    |(?<![\w+.-])(?P<card>\d(?:[ -]?\d){12,18})(?![\w])
    |(?<!\w)(?P<phone>(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]\d{3,4}|\+\d{7,15})(?!\w)""",
    "names": rf"\b(?P<name>{'|'.join(map(_name, CAPITAL))})\b",
}
DIGIT = re.compile(r"\d")
CAPITALISED = re.compile("(?:" + "|".join(CAPITAL.values()) + r")\w*")
LETTERS = re.compile(r"[^\W\d_]+")
STARTS = frozenset(x for w in [*TITLES, *(n for names in GIVEN.values() for n in names)] for x in (w, w.upper()))
_KEPT = frozenset(t.lower() for t in TITLES)
_GIVEN = frozenset(n.lower() for names in GIVEN.values() for n in names)


_compiled: dict[tuple[str, ...], re.Pattern] = {}


def pattern(kinds: tuple[str, ...]) -> re.Pattern:
    if kinds not in _compiled:
        _compiled[kinds] = re.compile("|".join(PATTERNS[k] for k in kinds), re.X)
    return _compiled[kinds]


def possible(text: str) -> tuple[str, ...]:
    """The patterns that can match at all: most texts hold no @, few hold digits, and names begin with listed words."""
    tests = {"email": "@" in text, "digits": DIGIT.search(text) is not None, "names": not STARTS.isdisjoint(CAPITALISED.findall(text))}
    return tuple(k for k, found in tests.items() if found)


def normal(kind: str, value: str) -> str:
    """What two mentions of one entity have in common."""
    if kind in ("card", "national"):
        return re.sub(r"\D", "", value)
    if kind == "phone":
        return re.sub(r"[^\d+]", "", value)
    return value.lower()


def name_words(value: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, role) of the words of a name that are replaced: given, initial or surname."""
    titles = True
    for m in LETTERS.finditer(value):
        word, after = m.group(), value[m.end() : m.end() + 1]
        low = word.lower()
        titles = titles and low in _KEPT
        if titles or word in PARTICLES or (len(word) == 1 and after in ("'", "’")):
            continue
        yield m.start(), m.end(), "given" if low in _GIVEN else "initial" if len(word) == 1 else "surname"


def drawn(kind: str, value: str) -> list[tuple[str, str]]:
    """The entities of a mention whose surrogates are drawn: (kind, normal form)."""
    if kind == "name":
        return [("surname", value[a:z].lower()) for a, z, role in name_words(value) if role == "surname"]
    return [(kind, normal(kind, value))]


_circles: dict[str, dict[str, str]] = {}


def circle(key: str) -> dict[str, str]:
    """Given names and initials by those that follow in a keyed order of their list: no two have one, none its own."""
    if key not in _circles:
        found: dict[str, str] = {}
        for group in [*([n.lower() for n in names] for names in GIVEN.values()), *map(list, INITIALS)]:
            order = sorted(group, key=lambda n: hmac.new(key.encode(), b"circle\0" + n.encode(), hashlib.sha256).digest())
            found |= dict(zip(order, [*order[1:], order[0]], strict=True))
        _circles[key] = found
    return _circles[key]


class Draw:
    """A stream of keyed random numbers."""

    def __init__(self, key: str, kind: str, entity: str, attempt: int):
        self.seed = hmac.new(key.encode(), f"{kind}\0{entity}\0{attempt}".encode(), hashlib.sha256).digest()
        self.bits, self.left, self.n = 0, 0, 0

    def below(self, n: int) -> int:
        if self.left < n << 40:
            self.n += 1
            self.bits = int.from_bytes(hashlib.sha256(self.seed + self.n.to_bytes(4, "big")).digest(), "big")
            self.left = 1 << 256
        self.bits, out = divmod(self.bits, n)
        self.left //= n
        return out


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _card(digits: str, draw: Draw) -> str:
    body = digits[0] + "".join(str(draw.below(10)) for _ in digits[1:-1])
    last = str(draw.below(10))
    if luhn(digits):
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))
    return body + (last if not luhn(body + last) else str((int(last) + 1) % 10))


def _ip(value: str, draw: Draw) -> str:
    a, b, *_ = (int(x) for x in value.split("."))
    fixed = [a] if a in (10, 127) else [a, b] if (a, b) == (192, 168) else [172, 16 + draw.below(16)] if a == 172 and 16 <= b < 32 else [1 + draw.below(223)]
    if len(fixed) == 1 and fixed[0] in (10, 127) and a not in (10, 127):
        fixed = [11]
    if fixed[0] == 192 and len(fixed) == 1 or fixed[0] == 172 and len(fixed) == 1:
        fixed = [193]
    return ".".join(map(str, [*fixed, *(draw.below(256) for _ in range(4 - len(fixed)))]))


def _spelt(value: str, draw: Draw) -> str:
    return "".join("abcdefghijklmnopqrstuvwxyz"[draw.below(26)] if c.isalpha() else str(draw.below(10)) if c.isdigit() else c for c in value)


def _surname(script: str, draw: Draw, n: int) -> str:
    syllables = SYLLABLES[script]
    return "".join(syllables[draw.below(len(syllables))] for _ in range(n))


def script_of(word: str) -> str:
    return next((s for s in ("cyrillic", "greek") if re.match(CAPITAL[s] + "|" + SMALL[s], word)), "latin")


LETTERS_26 = "abcdefghijklmnopqrstuvwxyz"
DIGITS_10 = "0123456789"


def _network(value: str) -> str:
    a, b, *_ = (int(x) for x in value.split("."))
    return f"{a}" if a in (10, 127) else "192.168" if (a, b) == (192, 168) else "172.16" if a == 172 and 16 <= b < 32 else "public"


def form(kind: str, entity: str) -> tuple[str, list[int]]:
    """The form of an entity (those of one form have the same values to choose from), and how many values each of its free places has."""
    if kind == "email":
        head, _, last = entity.rpartition(".")
        shape = "".join("a" if c.isalpha() else "0" if c.isdigit() else c for c in head)
        return f"{shape}.{last}", [26 if c == "a" else 10 for c in shape if c in "a0"]
    if kind == "ip":
        net = _network(entity)
        return net, {"192.168": [256, 256], "172.16": [16, 256, 256], "public": [256] * 4}.get(net, [256] * 3)
    if kind == "card":
        valid = luhn(entity)
        return f"{entity[0]}{len(entity)}{valid}", [10] * (len(entity) - 2) + ([] if valid else [9])
    keep = 2 if kind == "phone" and entity.startswith("+") else 0
    return f"{entity[:keep]}{len(entity)}", [10] * (len(entity) - keep)


def _values(kind: str, entity: str) -> list[int]:
    """What stands in the free places of an entity."""
    if kind == "email":
        return [(LETTERS_26 if c.isalpha() else DIGITS_10).index(c) for c in entity.rpartition(".")[0] if c.isalpha() or c.isdigit()]
    if kind == "ip":
        octets = [int(x) for x in entity.split(".")]
        return {"192.168": octets[2:], "172.16": [octets[1] - 16, *octets[2:]], "public": octets}.get(_network(entity), octets[1:])
    if kind == "card":
        middle = [int(c) for c in entity[1:-1]]
        return middle if luhn(entity) else [*middle, [d for d in DIGITS_10 if not luhn(entity[:-1] + d)].index(entity[-1])]
    return [int(c) for c in entity[2 if kind == "phone" and entity.startswith("+") else 0 :]]


def _filled(kind: str, like: str, values: list[int]) -> str:
    """The entity of the form of `like` with these values in its free places."""
    if kind == "email":
        head, _, last = like.rpartition(".")
        it = iter(values)
        return "".join(LETTERS_26[next(it)] if c.isalpha() else DIGITS_10[next(it)] if c.isdigit() else c for c in head) + "." + last
    if kind == "ip":
        net = _network(like)
        octets = {"192.168": [192, 168, *values], "172.16": [172, 16 + values[0], *values[1:]], "public": values}.get(net) or [int(net), *values]
        return ".".join(map(str, octets))
    if kind == "card":
        body = like[0] + "".join(map(str, values[: len(like) - 2]))
        if luhn(like):
            return next(body + d for d in DIGITS_10 if luhn(body + d))
        return body + [d for d in DIGITS_10 if not luhn(body + d)][values[-1]]
    keep = 2 if kind == "phone" and like.startswith("+") else 0
    return like[:keep] + "".join(map(str, values))


def _shuffled(key: str, name: str, n: int, x: int, back: bool = False) -> int:
    """A keyed permutation of 0 ... n-1 (a Feistel network over the next even number of bits, walked until it lands inside), or its inverse."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    rounds = range(7, -1, -1) if back else range(8)
    while True:
        a, b = x >> half, x & mask
        for k in rounds:
            f = lambda v, k=k: int.from_bytes(hmac.new(key.encode(), f"{name}\0{k}\0{v}".encode(), hashlib.sha256).digest()[:8], "big") & mask
            a, b = (b ^ f(a), a) if back else (b, a ^ f(b))
        x = a << half | b
        if x < n:
            return x


def permuted(key: str, kind: str, entity: str) -> str:
    """The value behind this one in a keyed order of all values of its form."""
    name, sizes = form(kind, entity)
    n = 1
    for size in sizes:
        n *= size
    x = 0
    for size, v in zip(sizes, _values(kind, entity), strict=True):
        x = x * size + v
    while True:
        x = _shuffled(key, f"{kind}\0{name}", n, (_shuffled(key, f"{kind}\0{name}", n, x, back=True) + 1) % n)
        left, values = x, []
        for size in reversed(sizes):
            left, v = divmod(left, size)
            values.append(v)
        made = _filled(kind, entity, values[::-1])
        if kind != "ip" or _network(made) == name:  # of public addresses, private ones are passed over
            return made


def surrogate(key: str, kind: str, entity: str, attempt: int = 0) -> str:
    """The surrogate of a normal form, as a normal form."""
    if attempt == PERMUTED:
        return permuted(key, kind, entity)
    draw = Draw(key, kind, entity, attempt)
    if kind == "card":
        return _card(entity, draw)
    if kind == "national":
        return "".join(str(draw.below(10)) for _ in entity)
    if kind == "phone":
        keep = 2 if entity.startswith("+") else 0
        return entity[:keep] + "".join(str(draw.below(10)) for _ in entity[keep:])
    if kind == "ip":
        return _ip(entity, draw)
    if kind == "email":
        head, _, last = entity.rpartition(".")
        return _spelt(head, draw) + "." + last
    return _surname(script_of(entity), draw, 4 + min(attempt, 4))


def _cased(word: str, like: str) -> str:
    return word.upper() if like.isupper() and len(like) > 1 else word.capitalize() if like[:1].isupper() else word


def dressed(kind: str, value: str, made: str) -> str:
    """A surrogate in the spacing, punctuation and case of the mention that it replaces."""
    if kind in ("card", "national", "phone"):
        signs = iter(made)
        return "".join(next(signs) if c.isdigit() or c == "+" else c for c in value)
    if kind == "email":
        return "".join(m.upper() if c.isupper() else m for m, c in zip(made, value, strict=True))
    return made


def renamed(value: str, key: str, surname) -> str:
    """A name word by word; `surname` gives the surrogate of one."""
    out, at = [], 0
    for a, z, role in name_words(value):
        word = value[a:z]
        low = word.lower()
        base = unicodedata.normalize("NFD", low)[0] if role == "initial" else low
        made = surname(low) if role == "surname" else circle(key).get(low) or circle(key).get(base, "x")
        out += [value[at:a], _cased(made, word)]
        at = z
    return "".join([*out, value[at:]])


def entities(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, kind, value) from left to right."""
    if not text or not (kinds := possible(text)):
        return
    found = [(m.start(), m.end(), m.lastgroup, m.group()) for m in pattern(kinds).finditer(text)]
    words = {v[a:z] for _, _, k, v in found if k == "name" for a, z, role in name_words(v) if role != "initial"}
    if words:  # mentions of these words alone, between what is found
        words = {w for x in words for w in (x, x.capitalize(), x.upper())}
        edges, alone = [(0, 0), *((a, z) for a, z, _, _ in found), (len(text), len(text))], []
        for (_, begin), (end, _) in zip(edges, edges[1:], strict=False):
            alone += [(m.start(), m.end(), "name", m.group()) for m in LETTERS.finditer(text, begin, end) if m.group() in words]
        found = sorted(found + alone)
    yield from found


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = lambda found: pa.record_batch([pa.array(x, pa.string()) for x in zip(*sorted(found), strict=True)], ["kind", "entity"])
    found: set[tuple[str, str]] = set()
    for b in batches:
        for text in b.column("text"):
            for _, _, kind, value in entities(text.as_py()):
                found.update(drawn(kind, value))
        if len(found) > REMEMBERED:
            yield pack(found)
            found = set()
    if found:
        yield pack(found)


def _draw_all(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = zip(*(b.column(c).to_pylist() for c in ("kind", "entity", "attempt")), strict=True)
        yield pa.record_batch([b.column("kind"), b.column("entity"), b.column("attempt"), pa.array([surrogate(key, *r) for r in rows], pa.string())], ["kind", "entity", "attempt", "surrogate"])


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Form and number of its values (as a double; surnames have any number)."""
    for b in batches:
        names, sizes = [], []
        for kind, entity in zip(b.column("kind").to_pylist(), b.column("entity").to_pylist(), strict=True):
            name, places = ("", [10] * 300) if kind == "surname" else form(kind, entity)
            n = 1.0
            for p in places:
                n *= p
            names.append(name)
            sizes.append(n)
        yield pa.record_batch([b.column("kind"), b.column("entity"), pa.array(names, pa.string()), pa.array(sizes, pa.float64())], ["kind", "entity", "form", "values"])


def assign(docs: DataFrame, key: str, rounds: int = MOST_ROUNDS) -> DataFrame:
    """(kind, entity, attempt, surrogate) of every distinct entity of `docs`; surrogates are distinct, and no originals but in permuted forms."""
    spark = docs.sparkSession
    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_gather, "kind string, entity string").distinct()
    schema = "kind string, entity string, attempt int, surrogate string"
    found = written(found.mapInArrow(_forms, "kind string, entity string, form string, values double"), "entities")
    # Only forms with few values, against all entities there are, can be full: a small part of the entities is counted by form.
    small = found.where(F.col("values") <= 4 * found.count())
    full = small.groupBy("kind", "form").agg(F.count("*").alias("n"), F.first("values").alias("values")).where(4 * F.col("n") > F.col("values")).select("kind", "form")
    draw = lambda df, attempt: df.withColumn("attempt", attempt).select("kind", "entity", "attempt").mapInArrow(lambda it: _draw_all(it, key), schema)
    path = new_path(spark, "surrogates")
    draw(found.join(full.withColumn("full", F.lit(True)), ["kind", "form"], "left"), F.when(F.col("full"), PERMUTED).otherwise(0)).write.parquet(path)
    for n in range(rounds + 1):
        now = spark.read.schema(schema).parquet(path)
        # A surrogate that several have stays with the one of the fewest attempts left to it: the earliest drawn, then the smallest.
        keeper = now.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "entity")).alias("keeper"), F.count("*").alias("n")).where("n > 1")
        clash = now.join(keeper, ["kind", "surrogate"]).where("entity != keeper.entity").select("kind", "entity")
        real = now.where(F.col("attempt") != PERMUTED).alias("a").join(now.alias("b"), F.expr("a.kind = b.kind and a.surrogate = b.entity"), "left_semi").select("kind", "entity")
        again = written(clash.union(real).distinct(), "again")
        if again.isEmpty():
            return now
        if n == rounds:  # what is left is of forms that are nearly full: permuted whole
            crowded = again.join(found, ["kind", "entity"]).where("kind != 'surname'").select("kind", "form").distinct()
            again = written(found.join(crowded, ["kind", "form"], "left_semi").select("kind", "entity"), "again")
        redrawn = draw(now.join(again, ["kind", "entity"], "left_semi"), F.lit(PERMUTED) if n == rounds else F.col("attempt") + 1)
        following = new_path(spark, "surrogates")
        now.join(again, ["kind", "entity"], "left_anti").select("kind", "entity", "attempt", "surrogate").unionByName(redrawn).write.parquet(following)
        drop_path(spark, path)
        path = following
    return spark.read.schema(schema).parquet(path)


def replace(text: str | None, key: str, exceptions: dict[tuple[str, str], str], known: dict[tuple[str, str], str]) -> tuple[str | None, list[dict]]:
    """The text with surrogates, and where each stands in it (code points)."""
    if text is None:
        return None, []
    out, spans, at, size = [], [], 0, 0

    def made(entity: tuple[str, str]) -> str:
        found = exceptions.get(entity) or known.get(entity)
        if found is None:
            if len(known) > REMEMBERED:
                known.clear()
            found = known[entity] = surrogate(key, *entity)
        return found

    for start, end, kind, value in entities(text):
        new = renamed(value, key, lambda w: made(("surname", w))) if kind == "name" else dressed(kind, value, made((kind, normal(kind, value))))
        size += start - at
        spans.append({"kind": kind, "start": size, "end": size + len(new)})
        out += [text[at:start], new]
        size, at = size + len(new), end
    return ("".join([*out, text[at:]]) if out else text), spans


def _apply(batches: Iterator[pa.RecordBatch], key: str, shared, own_name: str | None = None) -> Iterator[pa.RecordBatch]:
    exceptions, known = (shared.value if shared else {}), {}
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for b in batches:
        own = b.column(own_name).to_pylist() if own_name else None
        texts, spans = [], []
        for k, text in enumerate(b.column("text")):
            there = {(x["kind"], x["entity"]): x["surrogate"] for x in own[k] or ()} if own else exceptions
            t, s = replace(text.as_py(), key, there, known)
            texts.append(t)
            spans.append(s)
        names = [c for c in b.schema.names if c != own_name]
        cols = [pa.array(texts, pa.string()) if c == "text" else b.column(c) for c in names]
        yield pa.record_batch([*cols, pa.array(spans, spans_type)], [*names, "pii"])


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = {(i.as_py(), *e) for i, t in zip(b.column("h"), b.column("text"), strict=True) for _, _, k, v in entities(t.as_py()) for e in drawn(k, v)}
        if rows:
            cols = list(zip(*sorted(rows), strict=True))
            yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1]), pa.array(cols[2])], ["h", "kind", "entity"])


def pseudonymise(docs: DataFrame, key: str, broadcast_exceptions: int = BROADCAST_EXCEPTIONS) -> DataFrame:
    """`docs` with surrogates in `text`, and a column `pii` (kind, start, end of each in the new text)."""
    sc = docs.sparkSession.sparkContext
    docs = docs.drop("pii")
    later = assign(docs, key).where("attempt != 0").select("kind", "entity", "surrogate")
    docs = docs.withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in docs.schema), *T.StructType.fromDDL("pii array<struct<kind:string,start:int,end:int>>")])
    if (n := later.limit(broadcast_exceptions + 1).count()) <= broadcast_exceptions:
        shared = sc.broadcast({(r["kind"], r["entity"]): r["surrogate"] for r in later.collect()}) if n else None
        return docs.mapInArrow(lambda it: _apply(it, key, shared), schema)
    # Texts with exceptions get theirs by a hash; where two texts share it, each has those of both, and more than it needs.
    h, own_name = unused(docs, "h", "own")
    own = docs.select(F.xxhash64("text").alias("h"), "text").mapInArrow(_mentions, "h long, kind string, entity string")
    own = own.join(later, ["kind", "entity"]).groupBy(F.col("h").alias(h)).agg(F.collect_set(F.struct("kind", "entity", "surrogate")).alias(own_name))
    salt_by = F.col("doc_id") if "doc_id" in docs.columns else F.lit(0)
    rows = salted_join(docs.withColumn(h, F.xxhash64("text")), own, [h], salt_by).select(*(F.col(f"`{c}`") for c in docs.columns), own_name)
    return rows.mapInArrow(lambda it: _apply(it, key, None, own_name), schema)
