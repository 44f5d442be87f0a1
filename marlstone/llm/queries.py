"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages to archives and reads every record back by its index row."""
    from .warc import read, write

    records = read(write(table(spark, sf_dir, "pages")), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import TEST_KEY, pseudonymise

    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), TEST_KEY)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import jaccard_join

    return jaccard_join(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import THRESHOLD, held_out, score

    scored = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), lambda c: ~held_out(c))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import digest, scan

    return digest(scan(table(spark, sf_dir, "documents")))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents"))


def op7_table_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import place

    return place(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "slot", "shard")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge, production_rules

    return judge(table(spark, sf_dir, "pages"), production_rules(spark))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import written
    from .quality import features, judge, learn

    counts = written(features(table(spark, sf_dir, "documents")), "quality")
    judged = judge(counts, learn(counts, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .phrases import collocations

    return collocations(table(spark, sf_dir, "documents"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats all conversations and the probe, and reads them back."""
    from .chat import digests, render, with_probe

    return digests(render(with_probe(table(spark, sf_dir, "conversations"))))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .resample import resample

    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the mix that SQL can say."""
    return op6_source_mix(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and the base rule, without the learned list."""
    from .quality import base_failed, features

    return features(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"))


def secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base spans, without those of the battery."""
    return op5_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    numbered = {k: f for k, f in globals().items() if k.startswith("op") and k[2:3].isdigit()}
    return numbered | {"mix_targets": mix_targets, "quality_counts": quality_counts, "secret_spans": secret_spans}


def oracle_sql() -> dict[str, str]:
    from .oracles import ORACLES

    return dict(ORACLES)
