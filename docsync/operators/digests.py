"""Comparison of two document sets by checksums of ranges.

Rows are dealt into ranges by a hash of their id, the hash that also deals a target's documents into
its folders. Each side sums up its ranges: how many rows, and two checksums that do not depend on
their order. Only these sums are exchanged. Of ranges that differ, and only of those, ids and
row digests are joined; of a target only their folders are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsync.operators.ids import DOC_ID, WRITES

# Ranges of a comparison; the driver learns which of them differ.
RANGES = 4096


def _hashable(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return F.to_json(F.array_sort(F.map_entries(c)) if isinstance(kind, T.MapType) else c)
    return c


def row_digest(rows: DataFrame, columns, salt: int = 0) -> Column:
    """A 64-bit digest of the id and some fields. Nulls count by their place, so a value that moves
    to another field is a change."""
    parts = [F.col(DOC_ID)]
    for name in columns:
        c = F.col(f"`{name}`")
        parts += [c.isNull(), _hashable(c, rows.schema[name].dataType)]
    return F.xxhash64(F.lit(salt), *parts)


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Fields that both sides have, but for the id; their types must agree."""
    names = [c for c in left.columns if c in right.columns and c not in (DOC_ID, WRITES)]
    for name in names:
        kinds = [df.schema[name].dataType.simpleString() for df in (left, right)]
        if kinds[0] != kinds[1]:
            raise ValueError(f"field {name} is {kinds[0]} on one side and {kinds[1]} on the other")
    return names


def range_of(ranges: int) -> Column:
    return F.pmod(F.hash(DOC_ID), F.lit(ranges))


def range_digests(rows: DataFrame, columns, ranges: int = RANGES) -> DataFrame:
    """(range, rows, total, mixed) of the rows that have an id."""
    return rows.where(F.col(DOC_ID).isNotNull()).select(
        range_of(ranges).alias("range"), row_digest(rows, columns).alias("h"),
        row_digest(rows, columns, 1).alias("g")).groupBy("range").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("h").cast("decimal(20,0)")).alias("total"),
        F.bit_xor("g").alias("mixed"))


def differing_ranges(left: DataFrame, right: DataFrame, columns, ranges: int = RANGES) -> list[int]:
    """Ranges whose sums differ; at most ``ranges`` numbers."""
    a, b = (range_digests(df, columns, ranges).select(
        "range", F.struct("rows", "total", "mixed").alias(name)) for df, name in ((left, "a"), (right, "b")))
    found = a.join(b, "range", "full").where(~F.col("a").eqNullSafe(F.col("b")))
    return sorted(r["range"] for r in found.select("range").collect())


def differences(source: DataFrame, target: DataFrame, columns=None, ranges: int = RANGES,
                folders=None) -> DataFrame:
    """(doc_id, kind): ids that the target lacks (missing) or has beyond the source (orphan), ids
    with other content (changed), and ids that either side has more than once (repeated).

    Rows without an id take part in nothing. ``folders(ranges that differ)`` may give the target's
    rows anew, read from less than the whole.
    """
    columns = shared_columns(source, target) if columns is None else list(columns)
    differ = differing_ranges(source, target, columns, ranges)
    if folders is not None and differ:
        target = folders(differ)

    def rows(df: DataFrame, name: str) -> DataFrame:
        # One row per id: the sides are joined by unique ids, however often one is repeated.
        return df.where(F.col(DOC_ID).isNotNull() & range_of(ranges).isin(differ)).select(
            DOC_ID, F.struct(row_digest(df, columns), row_digest(df, columns, 1)).alias("d")).groupBy(
            DOC_ID).agg(F.count(F.lit(1)).alias(f"{name}_n"), F.min("d").alias(f"{name}_d"))
    if not differ:
        return source.select(F.col(DOC_ID).cast("string").alias(DOC_ID),
                             F.lit("").alias("kind")).limit(0)
    both = rows(source, "s").join(rows(target, "t"), DOC_ID, "full")
    kind = (F.when(F.col("t_n").isNull(), "missing").when(F.col("s_n").isNull(), "orphan")
            .when((F.col("s_n") > 1) | (F.col("t_n") > 1), "repeated")
            .when(F.col("s_d") != F.col("t_d"), "changed"))
    return both.select(DOC_ID, kind.alias("kind")).where(F.col("kind").isNotNull())
