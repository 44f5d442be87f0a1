"""URL filter: host-suffix and path-prefix expressions, equi-joins on short hash prefixes, then full digests.

A rule (host, path, verdict) fits a url whose host is the rule's or a subdomain of it and whose path starts with the
rule's. Each distinct url is expanded in two steps, so that its expressions are as many as could have a rule of their
host: its host suffixes (with the label counts that occur among the rules) meet the rules' hosts; those that have rules
are joined to the url's path prefixes of the lengths that occur under that host, and meet the rules. Both meet by the
first PREFIX_HEX digits of a SHA-256; the full digests decide. The longest rule wins (code points of host and path;
equally long ones by text; equal rules with different verdicts: block). A url without a rule gets `default`.

Host: what follows the first :// up to /, ? or #, with A-Z in lower case; path: what follows up to ? or #. A null or
empty url, or one without ://, has an empty host and path and no rule. Very long urls are expanded whole. Duplicate urls
are judged once and repeated rows, with null page_ids or not, are rows of their own. Extra columns are ignored. Without
pages the result is empty, without rules every verdict is `default`. Rules are broadcast up to BROADCAST_RULES rows;
beyond, distinct suffixes and expressions are shuffled to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import salted_join

PREFIX_HEX = 8
BROADCAST_RULES = 100_000
#: The rule set of the registered query.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _meet(tried: DataFrame, text: Column, known: DataFrame, small: bool) -> DataFrame:
    """Rows of `tried` (url, ...) whose `text` has a digest in `known` (digest, ...), with the columns of that."""
    tried = tried.withColumn("full", F.sha2(text, 256))
    short = known.withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
    prefix = F.substring("full", 1, PREFIX_HEX)
    if small:
        return tried.withColumn("prefix", prefix).join(F.broadcast(short), "prefix").where("full = digest").drop("prefix", "full", "digest")
    found = tried.select("full").distinct().withColumn("prefix", prefix).join(short, "prefix").where("full = digest").drop("prefix", "digest")
    return salted_join(tried, found, ["full"], F.col("url"), "inner").drop("full")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """(page_id, url) rows -> page_id, host, path, rule, verdict, in any order; one row for each given row."""
    pages = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url"))
    rules = rules.where("host is not null and path is not null").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block > allow
    hosts = rules.groupBy("host").agg(F.sort_array(F.collect_set(F.length("path"))).alias("lengths"))
    n_rules, counts = rules.agg(F.count("*"), F.collect_set(F.size(F.split("host", r"\.")))).first()
    small = n_rules <= broadcast_rules
    host, path = parts(F.col("url"))
    urls = pages.where("url is not null").select("url").distinct().select("url", host.alias("host"), path.alias("path")).where("host != ''")
    labels = F.split("host", r"\.")
    suffixes = F.array(*(F.when(F.size(labels) >= k, F.array_join(F.slice(labels, -k, k), ".")) for k in sorted(counts))) if counts else F.array().cast("array<string>")
    tried = urls.select("url", "path", F.explode(suffixes).alias("suffix")).where("suffix is not null")
    tried = _meet(tried, F.col("suffix"), hosts.select(F.sha2("host", 256).alias("digest"), "lengths"), small)
    tried = tried.select("url", "path", "suffix", F.explode("lengths").alias("n")).where("length(path) >= n")
    whole = lambda h, p: F.concat(h, F.lit("\n"), p)
    tried = tried.select("url", whole(F.col("suffix"), F.expr("substring(path, 1, n)")).alias("expression"))
    known = rules.select(F.sha2(whole(F.col("host"), F.col("path")), 256).alias("digest"), F.concat("host", "path").alias("rule"), "verdict")
    hits = _meet(tried, F.col("expression"), known, small)
    best = hits.groupBy("url").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best"))
    best = best.select("url", "best.rule", "best.verdict")
    out = salted_join(pages, best, ["url"], F.col("page_id"))
    return out.select("page_id", host.alias("host"), path.alias("path"), "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def production_rules(spark) -> DataFrame:
    return spark.createDataFrame(RULES, "host string, path string, verdict string")
