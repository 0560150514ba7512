"""Change-time filters written so that the scan can evaluate them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsync.functions.times import time_literal


def _inside(df: DataFrame, name: str, lo, hi) -> Column:
    column, data_type = F.col(name), df.schema[name].dataType
    inside = column.isNotNull()
    if lo is not None:
        inside = inside & (column > time_literal(lo, data_type))
    if hi is not None:
        inside = inside & (column < time_literal(hi, data_type))
    return inside


def changed_between(df: DataFrame, lo, hi, mod: str | None = "mod_date",
                    create: str = "create_date") -> DataFrame:
    """Rows whose change time lies strictly between lo and hi (either may be None).

    The change time is ``coalesce(mod, create)``.  Spark does not push a coalesce to parquet or
    JDBC, so the condition is spelled out per column; the rows are the same, and a row with both
    times null is never selected.
    """
    if mod is None:
        return df.where(_inside(df, create, lo, hi))
    return df.where(_inside(df, mod, lo, hi) | (F.col(mod).isNull() & _inside(df, create, lo, hi)))


def changed_before(df: DataFrame, hi, mod: str | None = "mod_date",
                   create: str = "create_date") -> DataFrame:
    return changed_between(df, None, hi, mod, create)
