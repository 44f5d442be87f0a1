"""Counts as reports show them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions import url as U


def by_language(key: str) -> Column:
    """An ordering of text as a reader expects it: accents and case come after letters."""
    return F.collate(F.col(key), "UNICODE")


def tally(df: DataFrame, field: str) -> DataFrame:
    """(field, n), the largest first, names in order among equals."""
    return df.groupBy(field).agg(F.count("*").alias("n")).orderBy(F.desc("n"), by_language(field))


def top(df: DataFrame, field: str, k: int = 15) -> DataFrame:
    return tally(df, field).limit(k)


def filled_tally(df: DataFrame, field: str, values: list[str]) -> DataFrame:
    """(field, n) for the given values in their order, zero where there is none, then others."""
    spark = df.sparkSession
    known = spark.createDataFrame(list(enumerate(values)), f"_at int, {field} string")
    counts = df.groupBy(field).agg(F.count("*").alias("n"))
    return known.join(counts, field, "full").select(field, F.coalesce("n", F.lit(0)).alias("n"), "_at").orderBy(F.col("_at").asc_nulls_last(), by_language(field)).drop("_at")


def distinct_domains(df: DataFrame, url: Column, approximate: bool = False) -> DataFrame:
    """How many hosts the urls have; all that have none count as one, `?`."""
    host = F.coalesce(U.host_col(url), F.lit("?"))
    return df.agg((F.approx_count_distinct if approximate else F.count_distinct)(host).alias("domains"))


def lines(counts: DataFrame, field: str, limit: int = 200) -> list[str]:
    """A small table of counts as text."""
    return [f"  {r['n']:>6}  {r[field]}" for r in counts.limit(limit).collect()]
