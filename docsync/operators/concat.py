"""Ordered text per key, also when one key holds a large share of all rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is concatenated in pieces.  It also bounds the set of such keys:
# n rows hold at most n / HOT_ROWS of them, about a million keys in 10**12 rows.
HOT_ROWS = 1_000_000


def _concat(rows: DataFrame, keys, text: Callable[[Column], Column], separator: str,
            name: str) -> DataFrame:
    """Only the items travel and are sorted; their text is written afterwards."""
    sorted_items = F.sort_array(F.collect_list("_item")).alias("_items")
    texts = F.array_join(F.transform("_items", text), separator)
    return (rows.groupBy(*keys).agg(sorted_items)
            .select(*keys, F.when(F.size("_items") > 0, texts).alias(name)))


def ordered_concat(rows: DataFrame, key: str, item: Column, text: Callable[[Column], Column],
                   separator: str = "", name: str = "text", hot_rows: int | None = None,
                   sizes: DataFrame | None = None) -> DataFrame:
    """One row per key: ``text`` of its items, joined in the order of the items.

    A list aggregate does not shrink under map-side combining, so a hot key would be sorted by one
    task.  Keys above ``hot_rows`` are therefore range-partitioned by (key, item): the ranges cut
    a hot key into consecutive pieces, each piece is joined where it lies, and only the finished
    pieces meet.  The hot keys are found by a count over the key column alone, or from ``sizes``
    (key, n) where the caller has a cheaper way to count.  When there is none, adaptive execution
    drops that whole branch and the anti join.
    """
    limit = HOT_ROWS if hot_rows is None else hot_rows
    rows = rows.select(F.col(key), item.alias("_item"))
    if sizes is None:
        sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hot = sizes.where(F.col("n") > limit).select(F.col(key).alias("_hot"))
    hot = F.broadcast(hot)  # bounded, see HOT_ROWS
    is_hot = F.col(key).eqNullSafe(F.col("_hot"))
    plain = _concat(rows.join(hot, is_hot, "left_anti"), (key,), text, separator, name)
    cut = (rows.join(hot, is_hot, "left_semi").repartitionByRange(key, "_item")
           .withColumn("_piece", F.spark_partition_id()))
    pieces = (_concat(cut, (key, "_piece"), text, separator, "_text")
              .select(key, F.when(F.col("_text").isNotNull(), F.struct("_piece", "_text"))
                      .alias("_item")))  # a piece without items only keeps its key
    joined = _concat(pieces, (key,), lambda piece: piece["_text"], separator, name)
    return plain.unionByName(joined)
