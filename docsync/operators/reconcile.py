"""Is everything there?  Source against target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsync.operators.ids import DOC_ID


def count_rows(rows: DataFrame, name: str = "total") -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias(name))


def compare_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: source_rows, target_rows, matches."""
    sides = source.select(F.lit(1).alias("s"), F.lit(0).alias("t")).union(
        target.select(F.lit(0), F.lit(1)))
    totals = sides.agg(F.coalesce(F.sum("s"), F.lit(0)).cast("bigint").alias("source_rows"),
                       F.coalesce(F.sum("t"), F.lit(0)).cast("bigint").alias("target_rows"))
    return totals.withColumn("matches", F.col("source_rows") == F.col("target_rows"))


def missing(source: DataFrame, target: DataFrame) -> DataFrame:
    """Ids of the source that the target lacks."""
    return _ids(source).join(target.select(DOC_ID), DOC_ID, "left_anti").distinct()


def orphans(source: DataFrame, target: DataFrame) -> DataFrame:
    """Ids of the target that the source lacks."""
    return missing(target, source)


def _ids(rows: DataFrame) -> DataFrame:
    return rows.select(DOC_ID).where(F.col(DOC_ID).isNotNull())
