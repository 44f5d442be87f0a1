"""The exported set: ready items with good alternatives, in 17 fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.columns import basename, filled
from marlstone.plans.schemas import EXPORTED


def exportable() -> Column:
    return (F.col("status") == "ready") & (F.col("alt_quality") == "good")


def export(items: DataFrame) -> DataFrame:
    """The exportable rows; a field that the table lacks is null."""
    return items.where(exportable()).select(*(F.col(c) if c in items.columns else F.lit(None).cast("string").alias(c) for c in EXPORTED))


def missing(items: DataFrame, files: DataFrame) -> DataFrame:
    """Exportable rows whose file is not in the archive."""
    rows = items.where(exportable()).select("id", F.when(filled(F.col("image_file")), basename(F.col("image_file"))).alias("name"))
    return rows.join(files.select("name"), "name", "left_anti")


def sizes(items: DataFrame) -> DataFrame:
    """One row: unreviewed, ready, dropped, and ready rows that are held back."""
    return items.agg(
        *(F.count_if(F.col("status") == s).alias(s) for s in ("unreviewed", "ready", "dropped")),
        F.count_if((F.col("status") == "ready") & ~F.coalesce(F.col("alt_quality") == "good", F.lit(False))).alias("held"),
    )


def pages(items: DataFrame) -> int:
    return items.where(exportable()).select("page_url").distinct().count()
