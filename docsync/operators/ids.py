"""Document ids, repeated ids and write outcomes."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsync.functions.text import column_text, doc_id, is_whole

DOC_ID = "doc_id"
# Number of source rows behind one document of a load
WRITES = "_writes"
# Why a row cannot become a document; empty or absent where it can
ERRORS = "_errors"
ERROR_TYPE = "array<struct<field: string, value: string, reason: string>>"


def with_doc_id(rows: DataFrame, id_columns, separator: str = "-") -> DataFrame:
    """Add ``doc_id``; it is null where an id column is null."""
    id_columns = [c.strip().lower() for c in id_columns]
    missing = [c for c in id_columns if c not in rows.columns]
    if missing:
        raise ValueError(f"id columns {missing} are not among {rows.columns}")
    if DOC_ID in rows.columns and id_columns != [DOC_ID]:
        raise ValueError(f"the source already has a column {DOC_ID}; rename it")
    rest = [F.col(f"`{c}`") for c in rows.columns if c != DOC_ID]
    return rows.select(doc_id(rows, id_columns, separator).alias(DOC_ID), *rest)


def rejected(docs: DataFrame) -> DataFrame:
    """Rows without a document id."""
    return docs.where(F.col(DOC_ID).isNull())


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def _one_per_id(docs: DataFrame, order, pick, pick_by, by: str | None) -> DataFrame:
    group = by or DOC_ID
    fields = [c for c in docs.columns if c not in (DOC_ID, group)]
    sortable = [c for c in fields if _orderable(docs.schema[c].dataType)]
    ranked = [*[c for c in order if c != group], *[c for c in sortable if c not in order]]
    rank = F.struct(*[F.col(f"`{c}`") for c in ranked], F.lit(0).alias("_"))
    if len(sortable) == len(fields):
        row = pick(rank)
    else:
        row = pick_by(F.struct(*[F.col(f"`{c}`") for c in fields]), rank)
    out = {c: F.col(f"_row.`{c}`").alias(c) for c in fields}
    if by is not None:
        out[by] = F.col(f"`{by}`")
    return (docs.groupBy(F.col(f"`{group}`"))
            .agg(row.alias("_row"), F.count(F.lit(1)).alias(WRITES))
            .select(column_text(docs, group).alias(DOC_ID),
                    *[out[c] for c in docs.columns if c != DOC_ID], WRITES))


def native_id(docs: DataFrame, id_columns) -> str | None:
    """The id column when it alone is the id and its values differ exactly where their texts do."""
    if len(id_columns) != 1 or id_columns[0] == DOC_ID:
        return None
    kind = docs.schema[id_columns[0]].dataType
    return id_columns[0] if is_whole(kind) or isinstance(kind, T.StringType) else None


def first_per_id(docs: DataFrame, order=(), unique: bool = False,
                 by: str | None = None) -> DataFrame:
    """The first row of every id and how many rows it stands for (``_writes``).

    "First" is by ``order`` and then by the other fields, so it does not depend on the layout of
    the data.  It is an aggregate, not a window: each task keeps one row per id before the
    shuffle, so an id that occurs very often costs no more than any other.

    ``by`` groups by the source column behind the id (see native_id) instead of the id text: a
    join on that column then needs no further shuffle, and a source bucketed by it needs none at
    all.  ``unique`` skips the search where the ids are a primary key.
    """
    if unique:
        return docs.withColumn(WRITES, F.lit(1).cast("bigint"))
    return _one_per_id(docs, order, F.min, F.min_by, by)


def last_per_id(docs: DataFrame, order=(), unique: bool = False) -> DataFrame:
    if unique:
        return docs.withColumn(WRITES, F.lit(1).cast("bigint"))
    return _one_per_id(docs, order, F.max, F.max_by, None)


def absent(docs: DataFrame, existing: DataFrame) -> DataFrame:
    """Documents whose id is not among the existing ids."""
    return docs.join(existing.select(DOC_ID), DOC_ID, "left_anti")


def tally(docs: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Rows (outcome, n) of an insert-if-absent load: created, conflict, rejected."""
    per_id = docs.groupBy(DOC_ID).agg(F.count(F.lit(1)).alias(WRITES))
    if existing is None:
        per_id = per_id.withColumn("_exists", F.lit(None).cast("boolean"))
    else:
        present = existing.select(DOC_ID, F.lit(True).alias("_exists"))
        per_id = per_id.join(present, DOC_ID, "left")
    has_id = F.col(DOC_ID).isNotNull()
    sums = per_id.agg(
        F.count_if(has_id & F.col("_exists").isNull()).alias("created"),
        F.sum(F.when(has_id, F.col(WRITES)).otherwise(0)).alias("writes"),
        F.sum(F.when(has_id, 0).otherwise(F.col(WRITES))).alias("refused"))
    return (sums.selectExpr("stack(3, 'created', created, 'conflict', writes - created, "
                            "'rejected', refused) as (outcome, n)").where("n > 0"))


class Outcomes(NamedTuple):
    created: DataFrame
    conflicts: DataFrame
    rejected: DataFrame


def outcomes(docs: DataFrame, existing: DataFrame | None = None, order=()) -> Outcomes:
    """The rows behind the tally.

    ``conflicts`` has each distinct refused row once, with the number of refused writes in
    ``refused``: equal copies are counted where they lie instead of being moved.
    """
    known = docs.where(F.col(DOC_ID).isNotNull())
    created = first_per_id(known, order).drop(WRITES)
    if existing is not None:
        created = absent(created, existing)
    fields = [f"`{c}`" for c in docs.columns]
    copies = known.groupBy(*fields).agg(F.count(F.lit(1)).alias("_copies"))
    winner = created.select(DOC_ID, F.struct(*fields).alias("_winner"))
    lost = F.col("_copies") - F.when(
        F.struct(*fields).eqNullSafe(F.col("_winner")), 1).otherwise(0)
    conflicts = (copies.join(winner, DOC_ID, "left").withColumn("refused", lost)
                 .where("refused > 0").select(*fields, "refused"))
    return Outcomes(created, conflicts, rejected(docs))
