"""Mixing of sources to target weights by pivotal rounding, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsync.llm.common import WORD, packed, stage, unpacked

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_COPIES = 2.0
#: Documents that one step of the reduction tree rounds against each other, on average.
BLOCK = 64
TINY = 1e-9


def source_targets(sizes: DataFrame) -> DataFrame:
    """Per source: ``size``, ``docs``, ``target``; from rows (source, size).

    Weights repeat over the sources in code point order, null last. Targets are filled like
    water: sources whose ceiling is lowest for their weight stop first, and the rest share what
    remains by weight. The table has one row per source; only it is ordered in one place.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS)).cast("int"))
    per = per.withColumn("weight", weight).withColumn("ceiling", F.col("size") * MAX_COPIES)
    per = per.withColumn("ratio", F.col("ceiling") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((SHARE * F.sum("size").over(whole)
              - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0)))
             / F.sum("weight").over(after))
    per = per.withColumn("level", level).withColumn("full", F.col("level") >= F.col("ratio"))
    # The level of the first source that is not full is the level of all such sources.
    shared = F.min(F.when(~F.col("full"), F.struct("ratio", "level"))).over(whole)["level"]
    target = F.when(F.col("full"), F.col("ceiling")).otherwise(shared * F.col("weight"))
    return per.withColumn("target", target).select("source", "size", "docs", "target")


def _item(p, s, h, row) -> Column:
    return F.struct(p.alias("p"), s.alias("s"), h.alias("h"), row.alias("row"))


def _pivot(a: Column, b: Column, u: Column) -> tuple[Column, Column]:
    """Move words between two fractional documents until one is whole; (whole one, other one).

    In words the sum stays, and each probability keeps its mean.
    """
    up = F.least((1 - a.p) * a.s, b.p * b.s)        # a gains, b loses
    down = F.least(a.p * a.s, (1 - b.p) * b.s)      # a loses, b gains
    gain = u * (up + down) < down
    moved = F.when(gain, up).otherwise(-down)
    first = F.when(gain, (1 - a.p) * a.s <= b.p * b.s).otherwise(a.p * a.s <= (1 - b.p) * b.s)
    pa, pb = a.p + moved / a.s, b.p - moved / b.s
    whole = F.when(first, _item(F.when(gain, 1.0).otherwise(0.0), a.s, a.h, a.row)).otherwise(
        _item(F.when(gain, 0.0).otherwise(1.0), b.s, b.h, b.row))
    other = F.when(first, _item(pb, b.s, b.h, b.row)).otherwise(_item(pa, a.s, a.h, a.row))
    return whole, other


def _unit(*key) -> Column:
    """A fixed pseudo-random number in [0, 1) of a key."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11) / F.lit(float(1 << 53))


def _rounded(blocks: DataFrame, seed: int, level: int) -> DataFrame:
    """Per block of items: the documents made whole (``done``) and one residual (``rest``)."""
    items = F.array_sort(F.collect_list(_item(F.col("p"), F.col("s"), F.col("h"), F.col("row"))),
                         lambda a, b: F.when(a.h < b.h, -1).when(a.h > b.h, 1).otherwise(0))
    grouped = blocks.groupBy("source", "block").agg(items.alias("items"))

    def step(state, item):
        whole, other = _pivot(state["rest"], item, _unit(
            F.lit(seed), F.lit(level), state["rest"]["h"], item["h"], F.size(state["done"])))
        return F.struct(F.array_append(state["done"], whole).alias("done"), other.alias("rest"))

    first = F.get("items", F.lit(0))
    start = F.struct(F.slice("items", 1, 0).alias("done"), first.alias("rest"))
    rest = F.slice("items", 2, F.size("items"))
    return grouped.select("source", F.aggregate(rest, start, step).alias("state")).select(
        "source", "state.*")


def mixed(docs: DataFrame, carry: list[str] | None = None, seed: int = 1) -> DataFrame:
    """Struct ``row`` (columns ``carry`` of a document, default all), ``size``, ``source_size``,
    ``target`` and ``copies`` (0 to 2) for every document.

    A document's copy number is its source's target over the source's size, rounded: the whole
    part is certain, the fraction is rounded against other documents of the source so that the
    source's words stay at its target but for at most one document. A null or blank text has
    size 0 and no effect. Null sources are one source. Repeated rows are documents of their own;
    which of equal rows is taken makes no difference. The same rows give the same mix in any
    partitioning. An empty table gives no rows.
    """
    names = docs.columns if carry is None else carry
    size = F.regexp_count(F.coalesce(docs["text"], F.lit("")), F.lit(WORD)).cast("long")
    rows = docs.select(packed(docs.select(*names)).alias("row"),
                       docs["source"].cast("string").alias("source"), size.alias("size"),
                       F.xxhash64(F.lit(seed), "doc_id", "source", "text").alias("h"))
    rows = stage(rows, "mixing")
    # Written, because its size then decides between broadcast and shuffle in the join.
    targets = stage(source_targets(rows.select("source", "size")), "targets")
    most = targets.agg(F.max("docs")).first()[0] or 0
    rows = rows.join(targets.withColumnsRenamed({"source": "_s", "size": "source_size"}),
                     F.col("source").eqNullSafe(F.col("_s")))
    f = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    base = F.floor(f + TINY)
    fraction = F.when(f - base > TINY, f - base).otherwise(0.0)
    facts = F.struct("row", "size", "source_size", "target", base.alias("base"))
    items = rows.select(facts.alias("row"), "source", "docs", fraction.alias("p"),
                        F.col("size").cast("double").alias("s"), "h")
    whole = (F.col("p") == 0) | (F.col("s") == 0)
    parts = [items.filter(whole).select("row", F.lit(0).alias("extra"))]
    # A tree: each level leaves one fractional document per block of the level before. The
    # blocks follow the source's size, so a hot source is many blocks, never one group.
    left, level = items.filter(~whole), 0
    while True:
        many = F.ceil(F.col("docs") / F.lit(float(BLOCK ** (level + 1))))
        left = left.withColumn("block", F.pmod(F.xxhash64(F.lit(level), "h"), many)).select(
            "source", "block", "docs", "p", "s", "h", "row")
        counts = targets.select(F.col("source").alias("_s"), "docs")
        out = stage(_rounded(left, seed, level), f"pivot{level}")
        parts.append(out.select(F.explode("done").alias("x")).select(
            "x.row", F.col("x.p").cast("int").alias("extra")))
        rest = out.select("source", "rest.*")
        if most <= BLOCK ** (level + 1):
            last = _unit(F.lit(seed), F.lit("last"), F.col("h")) < F.col("p")
            parts.append(rest.select("row", last.cast("int").alias("extra")))
            break
        # Residuals that came out whole are done; the others go up.
        whole = (F.col("p") <= TINY) | (F.col("p") >= 1 - TINY)
        parts.append(rest.filter(whole).select("row", F.round("p").cast("int").alias("extra")))
        left = rest.filter(~whole).join(counts, F.col("source").eqNullSafe(F.col("_s")))
        level += 1
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.select("row.*", (F.col("row.base") + F.col("extra")).cast("int").alias("copies")) \
        .drop("base")


def mix(docs: DataFrame) -> DataFrame:
    """Sizes, targets and words taken per document."""
    out = mixed(docs, ["doc_id"])
    return out.select("row.doc_id", "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).alias("taken"))


def take(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its own columns."""
    out = mixed(docs)
    copies = out.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies"))))
    return unpacked(copies, "row", docs.columns)
