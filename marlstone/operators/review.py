"""Review batches: their frozen input, checks of the verdicts, and applying them all or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.columns import not_blank
from marlstone.operators.validate import broken
from marlstone.plans.schemas import BATCH_INPUT, QUALITIES, SUBTYPES, VERDICTS

LEAST_REASON = 20


def batch_input(corpus: DataFrame, size: int = 30) -> DataFrame:
    """The first unreviewed items by `pos`, with a reviewer's field names."""
    first = corpus.where("status = 'unreviewed'").orderBy("pos").limit(size)
    return first.select(*(F.col(a).alias(b) if a in corpus.columns else F.lit(None).cast("string").alias(b) for a, b in BATCH_INPUT.items()), "pos")


def _no(test):
    return ~F.coalesce(test, F.lit(False))


def check(verdicts: DataFrame, corpus: DataFrame) -> DataFrame:
    """(line, item_id, problem) for verdicts (item_id, verdict, alt_quality, reason, subtype, line)."""
    again = F.row_number().over(Window.partitionBy("item_id").orderBy("line")) > 1
    v = verdicts.withColumn("again", again)
    c = corpus.select(F.col("id").alias("_id"), "status", "image_file").dropDuplicates(["_id"])
    j = v.join(c, v["item_id"] == c["_id"], "left")
    named, known = not_blank(F.col("item_id")), F.col("_id").isNotNull()
    keep = F.coalesce(F.col("verdict") == "keep", F.lit(False))
    tests = [
        ("item_id_blank", ~named),
        ("repeated_in_batch", named & F.col("again")),
        ("not_in_corpus", named & ~known),
        ("already_decided", known & _no(F.col("status") == "unreviewed")),
        ("verdict_value", known & _no(F.col("verdict").isin(*VERDICTS))),
        ("alt_quality_value", known & _no(F.col("alt_quality").isin(*QUALITIES))),
        ("reason_short", known & _no(F.length(F.trim("reason")) >= LEAST_REASON)),
        ("subtype_value", known & F.col("subtype").isNotNull() & _no(F.col("subtype").isin(*SUBTYPES))),
        ("keep_not_good", known & keep & _no(F.col("alt_quality") == "good")),
        ("keep_without_image", known & keep & ~not_blank(F.col("image_file"))),
    ]
    return broken(j, tests, "line", "item_id")


def merge(corpus: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The corpus with the verdicts on its unreviewed items; a corrected sub-type brings its category."""
    category = F.create_map(*(F.lit(x) for pair in SUBTYPES.items() for x in pair))
    v = verdicts.select("item_id", F.col("verdict").alias("_verdict"), F.trim("reason").alias("_reason"), F.col("alt_quality").alias("_quality"), F.col("subtype").alias("_subtype"))
    j = corpus.join(v, (corpus["id"] == v["item_id"]) & (corpus["status"] == "unreviewed"), "left")
    hit = F.col("item_id").isNotNull()
    fixed = hit & not_blank(F.col("_subtype")) & _no(F.col("_subtype") == F.col("subtype"))
    new = {
        "status": F.when(hit, F.when(F.col("_verdict") == "keep", "ready").otherwise("dropped")),
        "review_verdict": F.when(hit, F.col("_verdict")),
        "review_reason": F.when(hit, F.col("_reason")),
        "alt_quality": F.when(hit, F.col("_quality")),
        "subtype": F.when(fixed, F.col("_subtype")),
        "category": F.when(fixed, F.try_element_at(category, F.col("_subtype"))),
    }
    return j.select(*(F.coalesce(new[c], F.col(c)).alias(c) if c in new else F.col(c) for c in corpus.columns))


def apply(corpus: DataFrame, verdicts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(corpus, problems): one problem anywhere, and the corpus comes back as it was."""
    problems = check(verdicts, corpus)
    return (merge(corpus, verdicts) if problems.isEmpty() else corpus), problems


def counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """(status, n) of what a batch decided."""
    waiting = before.where("status = 'unreviewed'").select("id")
    return after.join(waiting, "id", "left_semi").where("status != 'unreviewed'").groupBy("status").count().withColumnRenamed("count", "n")
