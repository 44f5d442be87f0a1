"""Breadth-first crawl of hosts under caps, one DataFrame round a step, and redirect chains.

A host's state is its list of urls in order of discovery. Hosts are independent of each other, so a round takes the
next url of every host that has one left: as many rounds as the page cap, however many hosts there are. Each round's
state is written out, which cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions import url as U
from marlstone.operators.extract import outbound_links
from marlstone.operators.pool import capped, firsts
from marlstone.sources.scratch import keep

#: Rows of a task that joins chains, and chains that end at one place from which on it is joined apart.
ROWS, HOT = 250_000, 50_000


def resolve(starts: DataFrame, hops: DataFrame, most: int = 5) -> DataFrame:
    """(url) and a table (url, redirect, error, refused) -> (url, final, chain, error).

    `redirect` null is a page; a url that the table lacks fails. Chains double: every url of the table first knows one
    hop, then, by joining where its chain ends with the chain that begins there, two, four and so on. So 2**k hops take k
    joins for all urls at once, and a chain has at most twice `most` + 2 places. One that comes back to a place is cut
    there: a loop. The number of tasks goes with the rows, since short urls by the million are few bytes, which Spark would
    put into one task. Places where very many chains end are few: what is known of them is broadcast.
    """
    n = max(int(starts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(hops.count() + starts.count()) // ROWS))
    dealt = lambda df, key: df.repartition(n, key)
    begun = lambda: dealt(starts.select("url"), "url").distinct()
    refused = F.coalesce("refused", F.lit(False))
    stop = F.when(refused, "disallowed by robots.txt").when(F.col("error").isNotNull(), F.col("error")).when(F.col("redirect") == F.col("url"), "redirect loop")
    ends = stop.isNotNull() | F.col("redirect").isNull()
    known = dealt(hops.select("url", "redirect", "error", "refused"), "url").dropDuplicates(["url"])
    known = known.select("url", F.when(ends, F.array("url")).otherwise(F.array("url", "redirect")).alias("chain"), stop.alias("error"), ends.alias("done"))
    table = begun().join(known, "url", "left_anti").select("url", F.array("url").alias("chain"), F.lit("HTTP 404").alias("error"), F.lit(True).alias("done"))
    table, hop = _keep(known.unionByName(table)), 1
    while hop < most + 1:
        table = _keep(_doubled(table, dealt))
        hop *= 2
    long = ~F.col("done") | (F.size("chain") > most + 1)
    error = F.when(long, F.lit(f"more than {most} redirects")).otherwise(F.col("error"))
    chain = F.slice("chain", 1, most + 2)
    found = table.select("url", chain.alias("chain"), error.alias("error"))
    return begun().join(dealt(found, "url"), "url").select("url", F.when(F.col("error").isNull(), F.element_at("chain", -1)).alias("final"), "chain", "error")


def _doubled(table: DataFrame, dealt: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """(url, chain, error, done): chains that aren't done go on as the chains from their ends do."""
    next_ = table.select(F.col("url").alias("at"), F.col("chain").alias("more"), F.col("error").alias("then"), F.col("done").alias("over"))
    going = table.where("not done").withColumn("at", F.element_at("chain", -1)).drop("error", "done")
    many = _keep(dealt(going.select("at"), "at").groupBy("at").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("at"))
    hot = going.join(F.broadcast(many), "at", "left_semi").join(F.broadcast(next_.join(F.broadcast(many), "at", "left_semi")), "at", "left")
    going = dealt(going.join(F.broadcast(many), "at", "left_anti"), "at").join(dealt(next_, "at"), "at", "left").unionByName(hot)
    both = F.concat("chain", F.slice("more", 2, F.size("more")))
    going = going.withColumn("both", F.coalesce(both, "chain"))
    # The first place that was there before ends the chain.
    again = F.filter(F.sequence(F.lit(2), F.size("both")), lambda i: F.array_position(F.col("both"), F.element_at("both", i)) < i)
    going = going.withColumn("again", F.get(again, F.lit(0)))
    error = F.when(F.col("again").isNotNull(), "redirect loop").when(F.col("over").isNull(), "HTTP 404").otherwise(F.col("then"))
    done = F.col("again").isNotNull() | F.coalesce("over", F.lit(True))
    chain = F.when(F.col("again").isNotNull(), F.slice("both", F.lit(1), F.col("again") - 1)).otherwise(F.col("both"))
    return table.where("done").unionByName(going.select("url", chain.alias("chain"), error.alias("error"), done.alias("done")))


def _keep(df: DataFrame) -> DataFrame:
    return keep(df, "crawl")


def crawl(seeds: DataFrame, fetch: Callable[[DataFrame], DataFrame], pages_per_host: int = 12, follow: int = 8) -> tuple[DataFrame, DataFrame]:
    """(visits, pages): visits are (host, sector, url, final, error, round), pages (page_id, url, html, host, sector).

    `fetch` takes (url) and returns (url, final_url, html, error). The page cap of a host counts failures and
    redirect targets; `follow` counts the links that a host adds over the whole crawl. A host has the sector of its
    first seed; `sector_conflict` in the seeds' own table tells of others.
    """
    spark = seeds.sparkSession
    seeds = seeds.withColumn("host", U.host_col("url")).where("host is not null")
    first = seeds.groupBy("host").agg(F.min_by("sector", "pos").alias("sector"))
    queue = _keep(seeds.select("host", "url", F.col("pos").cast("long").alias("at")).groupBy("host", "url").agg(F.min("at").alias("at")))
    done = spark.createDataFrame([], "host string, url string, final string, error string, round int")
    pages = spark.createDataFrame([], "url string, html string, host string")
    added = spark.createDataFrame([], "host string, n long")
    for n in range(pages_per_host):
        seen = done.select("host", "url").union(done.where("final is not null").select("host", "final")).distinct()
        room = seen.groupBy("host").agg(F.count("*").alias("used"))
        rest = queue.join(seen, ["host", "url"], "left_anti").join(room, "host", "left").where(F.coalesce("used", F.lit(0)) < pages_per_host)
        turn = _keep(firsts(rest.select("host", "url", "at"), ["host"], ["at", "url"]).select("host", "url"))
        if turn.isEmpty():
            break
        got = _keep(fetch(turn.select("url").distinct()).join(turn, "url"))
        done = _keep(done.unionByName(got.select("host", "url", F.when(F.col("error").isNull(), F.coalesce("final_url", "url")).alias("final"), "error", F.lit(n).alias("round"))))
        new = got.where("error is null").select(F.coalesce("final_url", "url").alias("url"), "html", "host")
        pages = pages.unionByName(new)
        numbered = new.withColumn("page_id", F.xxhash64("host", "url"))
        links = outbound_links(numbered.select("page_id", "url", "html")).join(numbered.select("page_id", "host"), "page_id").select("host", F.col("link").alias("url"), "pos")
        known = queue.select("host", "url").union(done.select("host", "url")).union(done.where("final is not null").select("host", "final"))
        fresh = links.groupBy("host", "url").agg(F.min("pos").alias("pos")).join(known, ["host", "url"], "left_anti")
        fresh = capped(fresh.join(added, "host", "left"), "host", ["pos", "url"], F.lit(follow) - F.coalesce("n", F.lit(0)))
        fresh = _keep(fresh.select("host", "url", (F.lit((n + 1) << 32) + F.col("pos")).alias("at")))
        added = _keep(added.unionByName(fresh.groupBy("host").agg(F.count("*").alias("n"))).groupBy("host").agg(F.sum("n").alias("n")))
        queue = _keep(queue.unionByName(fresh))
    visits = done.join(first, "host")
    return visits, pages.join(first, "host").withColumn("page_id", F.xxhash64("host", "url"))


def outcomes(visits: DataFrame) -> DataFrame:
    """One row: pages, failed, disallowed."""
    return visits.agg(
        F.count_if(F.col("error").isNull()).alias("pages"),
        F.count_if(F.col("error").isNotNull() & ~F.contains("error", F.lit("robots"))).alias("failed"),
        F.count_if(F.contains(F.coalesce("error", F.lit("")), F.lit("robots"))).alias("disallowed"),
    )


def sector_conflicts(seeds: DataFrame) -> DataFrame:
    """Hosts that stand in several sectors' seed lists."""
    return seeds.withColumn("host", U.host_col("url")).groupBy("host").agg(F.collect_set("sector").alias("sectors")).where("size(sectors) > 1")
