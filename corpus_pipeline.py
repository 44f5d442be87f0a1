"""A corpus pipeline of five stages over `documents`; each reads what its predecessor kept.

toxicity: documents that score 0.3 and more go. near duplicates: one document of each group stays. decontamination:
documents that hold a benchmark item go. mixing: every document comes as often as the mix takes it (not at all, or
up to three times), shard by shard in a shuffled order. sharding: every row gets its shard in the lookup table.

Rows are judged by what they hold: null and repeated doc_ids, null, empty and very long texts, tables without rows and
columns of any names pass through every stage as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import common, decontaminate, jaccard, mixing, sharding, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, common.table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.place(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_copies),
    ("decontamination", drop_leaks),
    ("source_mix", mix_sources),
    ("table_sharding", assign_shards),
]

#: SQL can't express the learned and the iterated stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, old = common.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out, path = stage(spark, docs, sf_dir), common.new_path(spark, f"stage-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if old:
            common.drop_path(spark, old)
        old = path
    return docs
