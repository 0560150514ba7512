"""The three scans of a spec (all rows, one change window, given keys) and its extension rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsync.functions.text import join_keys
from docsync.functions.times import time_literal
from docsync.sources import params
from docsync.sources.changes import changed_between
from docsync.sources.jdbc import jdbc_query
from docsync.sources.pushed import per_column
from docsync.spec import SyncSpec


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def _run(spark: SparkSession, spec: SyncSpec, sql: str, times) -> DataFrame:
    if spec.jdbc is not None:
        options = dict(spec.jdbc)
        split = options.pop("split", None)
        return jdbc_query(spark, options, sql, times, split)
    sql, times = per_column(sql, times, spec.change_columns[1] if spec.created_first else None)
    if not times:
        return spark.sql(sql)
    # By name: Spark 4.1 mixes up the order of more than four values that are bound by place.
    names = [f"docsync_{i}" for i in range(len(times))]
    bound = {n: time_literal(t, spec.time_type) for n, t in zip(names, times)}
    return spark.sql(params.fill(sql, [f":{n}" for n in names]), args=bound)


def full(spark: SparkSession, spec: SyncSpec, now) -> DataFrame:
    """Every row changed before ``now``."""
    if spec.loads is not None:
        return lower_names(spec.loads(spark, now))
    if spec.source is not None:
        return changed_between(lower_names(spec.source(spark)), None, now, *spec.change_columns)
    return lower_names(_run(spark, spec, spec.init_sql, [now] * params.count(spec.init_sql)))


def window(spark: SparkSession, spec: SyncSpec, lo, hi) -> DataFrame:
    """The rows changed strictly between ``lo`` and ``hi``."""
    if spec.changes is not None:
        return lower_names(spec.changes(spark, lo, hi))
    if spec.sync_sql is not None:
        return lower_names(_run(spark, spec, spec.sync_sql,
                                params.window_values(spec.sync_sql, lo, hi)))
    if spec.source is not None:
        return changed_between(lower_names(spec.source(spark)), lo, hi, *spec.change_columns)
    raise ValueError(f"{spec.name}: no sync_sql, source or changes to read a window from")


def by_keys(spark: SparkSession, spec: SyncSpec, now, keys: Mapping | DataFrame) -> DataFrame:
    """The full scan restricted to given id values.

    A mapping holds one value per column; all of them must match, and each is cast to the type of
    its column (text that does not fit the type is an error).  A DataFrame holds many keys, one
    per row, under the names of the id columns.
    """
    rows = full(spark, spec, now)
    if isinstance(keys, DataFrame):
        keys = lower_names(keys)
        _check_columns(spec, rows, keys.columns)
        return rows.join(keys.dropDuplicates(), keys.columns, "left_semi")
    keys = {name.strip().lower(): value for name, value in keys.items()}
    _check_columns(spec, rows, keys)
    for name, value in keys.items():
        if value is None or str(value).strip() == "":
            raise ValueError(f"{spec.name}: key {name} has no value")
        text = value.strip() if isinstance(value, str) else value
        rows = rows.where(F.col(f"`{name}`") == F.lit(text).cast(rows.schema[name].dataType))
    return rows


def deleted_keys(spark: SparkSession, spec: SyncSpec) -> DataFrame:
    """The rows of the delete SQL: the id columns of documents that are to go."""
    return lower_names(_run(spark, spec, spec.delete_sql, []))


def _check_columns(spec: SyncSpec, rows: DataFrame, names) -> None:
    if not list(names):
        raise ValueError(f"{spec.name}: no key was given")
    unknown = [n for n in names if n not in rows.columns]
    if unknown:
        raise ValueError(f"{spec.name}: unknown key columns {unknown}")


def extension_rows(spark: SparkSession, spec: SyncSpec, ids: DataFrame | None = None):
    """The (parent id, key, value) rows of a spec, or None for a spec without extension; with
    ``ids`` (one column) those of the ids.

    An ``in (?)`` in the SQL stands for the ids of a batch. It is taken out of the text, so that a
    full load, which needs all rows, does not read the source again for its ids; a batch puts its
    ids around the text (``enrich.batch_rows``). Ids never become part of the SQL.
    """
    if spec.extension_column is None:
        return None
    if spec.ext_source is not None:
        return spec.ext_source(spark)
    if spec.ext_sql is None:
        return None
    text = params.without_id_list(spec.ext_sql)
    if params.count(text):
        raise ValueError(f"{spec.name}: ext_sql may have a ? only as an id list, in (?)")
    rows = _run(spark, spec, text, [])
    if ids is None:
        return rows
    wanted, parent = join_keys(ids, ids.columns[0], rows, rows.columns[0])
    return rows.join(ids.select(wanted.alias("_wanted")), parent == F.col("_wanted"), "left_semi")
