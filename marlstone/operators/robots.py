"""Robots rules: their lines as rows, and the join of urls with the rules of their origin.

A rule's path is a pattern: `*` is anything, a last `$` the end. Patterns meet paths through an index, not one by one:
each pattern is filed under the longer of its literal beginning and (if it is anchored) its literal end, and a path looks
up its own beginnings and ends, of the lengths that occur for its origin, by an equi-join. What is found is matched
segment by segment, each at the first place where it fits, which is linear in the path; of the rules that fit, the longest
decides, Allow at equal lengths (RFC 9309). Paths are dealt over SALTS, so an origin with most of the urls is no burden on one task.
"""

from __future__ import annotations

import re
from itertools import groupby, pairwise

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.sources.fetch import AGENT

SALTS = 16
LINE = re.compile(r"^[^\S\n]*(user-agent|allow|disallow)[^\S\n]*:([^#\n]*)", re.I | re.M)


def rules_for(text: str, agent: str = AGENT) -> list[tuple[bool, str]]:
    """(allow, path) of the groups that name the agent, or else of those for all: for a fetcher that asks as it goes."""
    blocks = [(named, list(lines)) for named, lines in groupby(LINE.findall(text or ""), lambda x: x[0].lower() == "user-agent")]
    found = [({v.strip().lower() for _, v in names}, [(f.lower() == "allow", v.strip()) for f, v in rules]) for (named, names), (_, rules) in pairwise(blocks) if named]
    own = [rules for names, rules in found if any(a in agent.lower() for a in names - {"*"})]
    return sum(own or [rules for names, rules in found if "*" in names], [])


def fits(pattern: str, path: str) -> bool:
    """Whether a pattern fits a path, in time linear in the path for each of its segments."""
    anchored = pattern.endswith("$")
    head, *rest = pattern.removesuffix("$").split("*")
    if not path.startswith(head):
        return False
    at, tail = len(head), rest.pop() if anchored and rest else None
    for part in rest:
        at = path.find(part, at)
        if at < 0:
            return False
        at += len(part)
    return at == len(path) if anchored and tail is None else tail is None or path.endswith(tail) and len(path) - len(tail) >= at


def allows(rules: list[tuple[bool, str]], url_path: str) -> bool:
    """The longest rule that fits decides, Allow at equal lengths; without any it is allowed."""
    return max(((len(p), allow) for allow, p in rules if p and fits(p, url_path)), default=(0, True))[1]


def rule_table(robots: DataFrame, agent: str = AGENT) -> DataFrame:
    """(origin, text) -> origin, allow, path of each rule for the agent; a null text is permissive.

    Lines are rows. A group begins at an agent line that doesn't follow another one; the groups that name the agent
    count, or else those for all.
    """
    lines = robots.select("origin", "text").dropDuplicates(["origin"]).select("origin", F.posexplode(F.split("text", "\n")).alias("line", "raw"))
    clean = F.regexp_replace("raw", "#.*", "")
    field = F.lower(F.trim(F.regexp_extract(clean, r"^([^:]*):", 1)))
    value = F.regexp_replace(F.regexp_extract(clean, r"(?s)^[^:]*:(.*)$", 1), r"^\s+|\s+$", "")
    lines = lines.select("origin", "line", F.regexp_replace(field, r"^\s+|\s+$", "").alias("field"), value.alias("value")).where(F.col("field").isin("user-agent", "allow", "disallow"))
    order = Window.partitionBy("origin").orderBy("line")
    names = F.col("field") == "user-agent"
    begins = names & F.coalesce(F.lag("field").over(order) != "user-agent", F.lit(True))
    lines = lines.withColumn("group", F.sum(begins.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    own = names & (F.col("value") != "*") & F.contains(F.lit(agent.lower()), F.lower("value"))
    groups = lines.where("group > 0").groupBy("origin", "group").agg(
        F.bool_or(own).alias("own"),
        F.bool_or(names & (F.col("value") == "*")).alias("every"),
        F.collect_list(F.when(~names & (F.col("value") != ""), F.struct((F.col("field") == "allow").alias("allow"), F.col("value").alias("path")))).alias("rules"),
    )
    some = F.bool_or("own").over(Window.partitionBy("origin"))
    groups = groups.withColumn("some", some).where(F.when(F.col("some"), F.col("own")).otherwise(F.col("every")))
    return groups.select("origin", F.explode("rules").alias("r")).select("origin", "r.allow", "r.path")


def indexed(rules: DataFrame) -> DataFrame:
    """`rules` with head, middle (array), tail, anchored; and `literal`, under which each is filed, with `at_end`."""
    anchored = F.endswith("path", F.lit("$"))
    parts = F.split(F.when(anchored, F.expr("left(path, length(path) - 1)")).otherwise(F.col("path")), r"\*", -1)
    r = rules.where("path != ''").select("origin", "allow", F.length("path").alias("size"), anchored.alias("anchored"), parts.alias("parts"))
    several = F.size("parts") > 1
    r = r.withColumn("tail", F.when(F.col("anchored") & several, F.element_at("parts", -1)))
    r = r.withColumn("middle", F.when(several, F.slice("parts", 2, F.size("parts") - F.when(F.col("anchored"), 2).otherwise(1))).otherwise(F.array().cast("array<string>")))
    r = r.select("origin", "allow", "size", "anchored", F.col("parts")[0].alias("head"), F.filter("middle", lambda x: x != "").alias("middle"), "tail")
    end = F.coalesce(F.length("tail") > F.length("head"), F.lit(False))
    return r.withColumn("at_end", end).withColumn("literal", F.when(end, F.col("tail")).otherwise(F.col("head")))


def matches(path: Column) -> Column:
    """Whether the pattern of an `indexed` rule fits `path`: a segment after the other, from the first place where it fits on."""

    def step(at: Column, part: Column) -> Column:
        found = F.call_function("locate", part, path, at)
        return F.when((at == 0) | (found == 0), 0).otherwise(found + F.length(part))

    at = F.aggregate("middle", F.when(F.startswith(path, F.col("head")), F.length("head") + 1).otherwise(0), step)
    tail = F.endswith(path, F.col("tail")) & (F.length(path) - F.length("tail") + 1 >= at)
    return (at > 0) & F.when(~F.col("anchored"), True).when(F.col("tail").isNull(), at == F.length(path) + 1).otherwise(tail)


def decide(urls: DataFrame, rules: DataFrame, url: str = "url", origin: str = "origin", path: str = "path") -> DataFrame:
    """`urls` with `allowed`."""
    table = indexed(rules)
    salts = lambda df: df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    pairs = urls.select(F.col(origin).alias("origin"), F.col(path).alias("p")).distinct().withColumn("salt", F.pmod(F.xxhash64("p"), F.lit(SALTS)).cast("int"))
    lengths = table.groupBy("origin").agg(F.collect_set(F.struct("at_end", F.length("literal").alias("n"))).alias("lengths"))
    looked = pairs.join(salts(lengths), ["origin", "salt"]).select("origin", "salt", "p", F.explode(F.filter("lengths", lambda x: x["n"] <= F.length("p"))).alias("x"))
    literal = F.when(F.col("x.at_end"), F.expr("right(p, x.n)")).otherwise(F.expr("left(p, x.n)"))
    looked = looked.select("origin", "salt", "p", F.col("x.at_end").alias("at_end"), literal.alias("literal"))
    found = looked.join(salts(table), ["origin", "salt", "at_end", "literal"]).where(matches(F.col("p")))
    best = found.groupBy(F.col("origin").alias(origin), F.col("p").alias(path)).agg(F.max_by("allow", F.struct("size", "allow")).alias("allowed"))
    return urls.join(best, [origin, path], "left").withColumn("allowed", F.coalesce("allowed", F.lit(True)))


def path_and_query(url: Column) -> Column:
    tail = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    return F.when(tail.startswith("/"), tail).otherwise(F.concat(F.lit("/"), tail))


def origin(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1))
