"""The candidate pool: what is new, and its ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.columns import item_id, item_number
from marlstone.sources.scratch import ranked

KEY = ("page_url", "picture", "element_role", "accessible_name")


def keyed(items: DataFrame) -> DataFrame:
    return items.withColumn("picture", F.coalesce("image_url", "element_html"))


def firsts(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by `order`: a minimum, which combines before the shuffle, so a hot key burdens no task."""
    first = F.min_by(F.struct("*"), F.struct(*order)).alias("x")
    return df.groupBy(*(F.col(k).alias(f"_key{n}") for n, k in enumerate(keys))).agg(first).select("x.*")


def unseen(df: DataFrame, have: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of `df` whose key `have` lacks; nulls are equal to each other."""
    have = have.select(*keys).distinct().alias("p")
    same = None
    for k in keys:
        part = df[k].eqNullSafe(F.col(f"p.{k}"))
        same = part if same is None else same & part
    return df.join(have, same, "left_anti")


def capped(df: DataFrame, key: str, order: list[str | Column], most: Column | int) -> DataFrame:
    """The first `most` rows of each key by `order`."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_nth", nth).where(F.col("_nth") <= most).drop("_nth")


def fresh(found: DataFrame, pool: DataFrame, order: list[str] | None = None) -> DataFrame:
    """`found` without what the pool has by key, the first of each key by `order`."""
    return unseen(firsts(keyed(found), list(KEY), order or ["pos"]), keyed(pool), list(KEY)).drop("picture")


def last_number(pool: DataFrame) -> int:
    return pool.agg(F.max(item_number(F.col("id")))).first()[0] or 0


def number(items: DataFrame, last: int, order: list[str | Column]) -> DataFrame:
    """Gives ids from last + 1 on, in order."""
    return ranked(items, order, "_rank").withColumn("id", item_id(F.col("_rank") + last + 1)).drop("_rank")


def add(found: DataFrame, pool: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The new candidates with their ids; `dry run` is to look at them and not append them."""
    order = order or ["pos"]
    return number(fresh(found, pool, order), last_number(pool), order)
