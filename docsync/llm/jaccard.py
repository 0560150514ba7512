"""Set-similarity join of word shingles with adaptive multi-match prefixes.

A document is its set of 5-word shingles (64-bit hashes). Two link when
100 * intersection >= 75 * union.

* Documents with equal sets are one class; the classes are joined.
* Window. Of a set only its smallest hashes are sent (all of a small set): when two sets link,
  the windows of both share a guaranteed number of hashes.
* Prefix. Within its window a class orders the hashes from rare to frequent over all classes. If it
  must share m hashes with a partner, they share m within the first |window| - guaranteed + m. A
  longer prefix costs more postings and asks for more matches; each class takes the m with the
  least estimated cost. Hashes that no other window has are never sent again.
* Pairs inside one component need no test. First every class is tested against the most central
  class of each of its postings; what that links is one component.
* Classes that still meet classes of other components send their whole sets. Against whole sets the
  bounds are as tight as they can be: of two sets that link, the smaller shares all but a seventh of
  its hashes, the larger all but a quarter. Hashes that one component alone has come first in every
  prefix, so classes that share long passages, but not enough of them, do not meet. Here a prefix
  may ask for any number of matches. Every posting carries a sketch of its set, and pairs whose
  sketches differ too much for a link are left out of the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsync.llm.common import (drop, encoded, mix64, noise, packed, stage, steps, told_words,
                                unpacked)
from docsync.llm.components import components

WORDS = 5
PERCENT = 75
#: Hashes of a set whose reading costs a verification as much as one posting.
VERIFY = 16
#: Most matches a prefix of a window may ask for; prefixes of whole sets have no such bound.
MATCHES = 4
#: Sets up to this size are sent whole; of larger ones the share WINDOW of the rest as well.
WHOLE = 128
WINDOW = 0.3
#: 64-bit parts of the sketch of a whole set.
SKETCH = 8
#: Document frequencies are counted up to here; more frequent hashes are equally last.
FREQUENT = 1 << 16
BITS = [f"bits{i}" for i in range(SKETCH)]
_MIX = noise(WORDS, 5)


def shingles(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for a, b in steps(texts):
        hashes, first = told_words(texts[a:b])
        n = len(hashes)
        sums = np.zeros(max(0, n - WORDS + 1), np.uint64)
        for j in range(WORDS):
            sums += mix64(hashes[j:n - WORDS + 1 + j] ^ _MIX[j]) if len(sums) else 0
        sums = mix64(sums)
        for i in range(b - a):
            x, y = first[i], first[i + 1]
            if y - x >= WORDS:
                yield np.unique(sums[x:y - WORDS + 1])
            elif y > x:  # too short for a shingle: the whole sequence, marked by its length
                short = mix64(hashes[x:y] ^ _MIX[:y - x])
                yield mix64(np.array([short.sum() ^ np.uint64(y - x)], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def set_id(values: np.ndarray) -> int:
    """A 64-bit id of a set; equal for equal sets."""
    if not len(values):
        return 0
    total = mix64(values ^ np.uint64(0xA0761D6478BD642F)).sum(keepdims=True)
    return int(mix64(total + np.uint64(len(values))).view(np.int64)[0])


def window_size(n: np.ndarray) -> np.ndarray:
    """Hashes that a set of n sends."""
    n = np.asarray(n, np.int64)
    return np.where(n <= WHOLE, n, WHOLE + np.floor(WINDOW * (n - WHOLE)).astype(np.int64))


def guaranteed(n: np.ndarray) -> np.ndarray:
    """So many hashes the windows of a set of n and of any partner share.

    When two sets link, each lacks at most a quarter of the other's hashes, so the j-th shared hash
    has at most rank n // 4 + j, and the first |window| - n // 4 shared ones are in the window. The
    smallest partner has m = 3 n / 4 hashes. Up to WHOLE hashes that count is m - m // 4, beyond it
    is at least the line below; the minimum keeps the bound from falling where the two meet.
    """
    m = -(-3 * np.asarray(n, np.int64) // 4)
    line = np.floor(WHOLE * (1 - WINDOW) - 1 + (WINDOW - 0.25) * np.maximum(m, WHOLE) - 1e-9)
    return np.maximum(1, np.minimum(m - m // 4, line.astype(np.int64)))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [(len(s), set_id(s)) for s in shingles(encoded(batch["text"]))]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array([n for n, _ in sets], pa.int64()),
             pa.array([i for _, i in sets], pa.int64())], ["doc_id", "n_shingles", "sid"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Window hashes of each class; a task sends a class once, however many copies it meets."""
    sent: set[int] = set()
    for batch in batches:
        for s in shingles(encoded(batch["text"])):
            sid, n = set_id(s), len(s)
            if not n or sid in sent:
                continue
            sent.add(sid)
            part = s[:int(window_size(n))].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(np.full(len(part), sid)),
                 pa.array(np.full(len(part), n, np.int32))], ["h", "sid", "n"])


def batched(rows: Iterator[pa.RecordBatch], least: int = 50000) -> Iterator[pa.RecordBatch]:
    """Small batches joined to larger ones."""
    held, count = [], 0
    for batch in rows:
        held.append(batch)
        count += batch.num_rows
        if count >= least:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, count = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h, sid) to distinct rows with df, the number of classes that have h, for
    df of 2 or more. Only the first FREQUENT rows of a hash are ever held."""
    held: list[pa.RecordBatch] = []

    def told(table: pa.Table, last: bool, state: dict):
        h, sid = np.asarray(table["h"]), np.asarray(table["sid"])
        n = np.asarray(table["n"])
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (sid[1:] != sid[:-1])))
        if len(h) and state.get("last") == (h[0], sid[0]):
            new[0] = False
        h, sid, n = h[new], sid[new], n[new]
        starts = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else []
        counts = np.diff(np.append(starts, len(h)))
        df = np.repeat(np.minimum(counts, FREQUENT), counts) if len(h) else np.zeros(0, int)
        df[h == state.get("hot")] = FREQUENT  # its first rows went out before
        cut = len(h)
        if not last and len(h):
            tail = counts[-1]
            if tail < FREQUENT and h[-1] != state.get("hot"):
                cut = len(h) - tail  # the run may go on: keep it
            else:
                state["hot"] = h[-1]
        keep = np.flatnonzero(df[:cut] > 1)
        out = pa.RecordBatch.from_arrays(
            [pa.array(sid[keep]), pa.array(n[keep]), pa.array(h[keep]),
             pa.array(df[keep].astype(np.int32))], ["sid", "n", "h", "df"])
        rest = pa.Table.from_arrays([pa.array(h[cut:]), pa.array(sid[cut:]), pa.array(n[cut:])],
                                    ["h", "sid", "n"])
        if len(h):
            state["last"] = (h[-1], sid[-1]) if cut == len(h) else None
        return out, rest

    state: dict = {}
    rest = None
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < 100000:
            continue
        table = pa.Table.from_batches(held).select(["h", "sid", "n"])
        held = []
        table = table if rest is None else pa.concat_tables([rest.cast(table.schema), table])
        out, rest = told(table.combine_chunks(), False, state)
        yield out
    tables = [t for t in (rest, pa.Table.from_batches(held).select(["h", "sid", "n"])
                          if held else None) if t is not None]
    if tables:
        table = pa.concat_tables([t.cast(tables[-1].schema) for t in tables]).combine_chunks()
        yield told(table, True, state)[0]


def prefixes(n: int, df: np.ndarray, h: np.ndarray):
    """(hash, least m whose prefix has it, place) of a class's prefixes up to MATCHES, and its m.

    ``df`` and ``h``: the hashes of its window that other classes have; all others come first.
    """
    w, sure = int(window_size(n)), int(guaranteed(n))
    order = np.lexsort((h, df))
    alone = w - len(h)
    most = min(MATCHES, sure)
    ends = np.arange(1, most + 1) + (w - sure) - alone  # prefix ends, in hashes of ``order``
    ends = np.clip(ends, 0, len(h))
    if ends[-1] == 0:
        return None
    # Cost: postings to read, and candidates to verify; asking for m matches leaves about 1/m of
    # the postings' partners, in terms of postings a verification costs the set's size / 16.
    posts = np.concatenate(([0], np.cumsum(df[order].astype(np.int64) - 1)))[ends]
    m = int(np.argmin(posts + posts / np.arange(1, most + 1) ** 2 * (n / 16))) + 1
    take = order[:ends[-1]]
    least = np.searchsorted(ends, np.arange(1, ends[-1] + 1)) + 1
    return h[take], least, alone + np.arange(1, ends[-1] + 1), m


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["h", "sid", "n", "least", "place", "m", "alone"]
    for batch in batches:
        out = []
        for sid, n, seen in zip(*(batch[c].to_pylist() for c in ("sid", "n", "seen"))):
            found = prefixes(n, np.array([s["df"] for s in seen]),
                             np.array([s["h"] for s in seen], np.int64))
            if found:
                h, least, place, m = found
                alone = int(window_size(n)) - len(seen)
                out += [(a, sid, n, b, c, m, alone) for a, b, c in zip(
                    h.tolist(), least.tolist(), place.tolist())]
        columns = list(zip(*out)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (
                pa.int64(), pa.int64(), *[pa.int32()] * 5))], names)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # A repeated doc_id may bring a text of another class: only the class's own is taken.
        found = [(sid, s.tobytes()) for sid, s in zip(
            batch["sid"].to_pylist(), shingles(encoded(batch["text"]))) if set_id(s) == sid]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int64()),
             pa.array([f[1] for f in found], pa.binary())], ["sid", "items"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch["a"], batch["b"]
        good = []
        for x, y in zip(batch["items_a"], batch["items_b"]):
            x = np.frombuffer(x.as_buffer(), np.uint64)
            y = np.frombuffer(y.as_buffer(), np.uint64)
            small, large = (x, y) if len(x) < len(y) else (y, x)
            at = np.searchsorted(large, small)
            common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
            good.append(100 * common >= PERCENT * (len(x) + len(y) - common))
        keep = pa.array(good, pa.bool_())
        yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(keep)


def _can_link(x: str, y: str):
    """Sizes and places allow a link: |x & y| must be at least 3/7 of both sizes, and what
    precedes the first match in either window's order is not shared."""
    n, k = F.col(f"{x}.n"), F.col(f"{y}.n")
    least = F.ceil((n + k) * 3 / F.lit(7.0) - 1e-9)

    def outside(s):  # hashes that do not belong to the window
        return F.greatest(F.lit(0), F.floor(F.lit(0.0) + (1 - WINDOW) * (
            F.col(f"{s}.n") - WHOLE) + 1 - 1e-9))
    left = F.least(n - outside(x) - F.col(f"{x}.place"),
                   k - outside(y) - F.col(f"{y}.place")) + MATCHES
    return (4 * n >= 3 * k) & (4 * k >= 3 * n) & (
        left >= least - F.greatest(outside(x), outside(y)))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    first = sets.select(F.col("sid").alias("a"), F.col("items").alias("items_a"))
    second = sets.select(F.col("sid").alias("b"), F.col("items").alias("items_b"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "items_a", "items_b") \
        .mapInArrow(_verified, "a long, b long")


def class_links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Verified links (a, b) between class ids, enough to connect all that links connect."""
    rows = docs.select("text").mapInArrow(lambda it: batched(_windows(it)),
                                          "h long, sid long, n int")
    seen = rows.repartition("h").sortWithinPartitions("h", "sid").mapInArrow(
        _frequencies, "sid long, n int, h long, df int")
    posts = stage(
        seen.groupBy("sid", "n").agg(F.collect_list(F.struct("h", "df")).alias("seen"))
        .mapInArrow(_postings, "h long, sid long, n int, least int, place int, m int, alone int"),
        "postings")
    needed = posts.select("sid").distinct().join(classes, "sid").select("sid", "doc_id")
    sets = stage(docs.join(needed, "doc_id").select("sid", "text")
                 .mapInArrow(_sets, "sid long, items binary"), "sets")
    # 1. The most central class of each posting: the one with the fewest hashes of its own.
    centre = posts.groupBy("h").agg(F.count("*").alias("c"), F.min(F.struct(
        "alone", "sid", "n", "place")).alias("y")).filter("c > 1").select("h", "y.*")
    pairs = posts.alias("x").join(centre.alias("y"), "h").filter(
        (F.col("x.sid") != F.col("y.sid")) & _can_link("x", "y")).select(
        F.col("x.sid").alias("a"), F.col("y.sid").alias("b")).distinct()
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = stage(_links(pairs, sets), "links")
    parts = stage(components(links), "parts")
    # 2. Across components.
    parted = posts.join(parts.withColumnRenamed("id", "sid"), "sid", "left").select(
        "h", "sid", F.coalesce("component", "sid").alias("part"))
    meet = parted.groupBy("h").agg(F.min("part").alias("p"), F.max("part").alias("q")) \
        .filter("p <> q").select("h")
    left = stage(parted.join(meet, "h", "left_semi").select("sid", "part").distinct(), "left")
    more = stage(_links(across(sets.join(left, "sid")), sets), "links")
    for done in (sets, posts, parts, left):
        drop(done)
    return links.unionByName(more)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for sid, part, items in zip(batch["sid"].to_pylist(), batch["part"].to_pylist(), batch["items"]):
            h = np.frombuffer(items.as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(np.full(len(h), sid)), pa.array(np.full(len(h), part)),
                 pa.array(np.full(len(h), len(h), np.int32))], ["h", "sid", "part", "n"])


def whole_prefix(n: int, df: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, int, float]:
    """Hashes of a whole set in the order of its prefixes, the number of matches it asks for if one is
    too costly, and the estimated cost of that.

    ``df`` and ``h``: its hashes that other components have; all others come first. As the smaller
    of two sets it shares at least 6/7 of its hashes with a partner, so m of them are among the first
    n - 6 n / 7 + m. Of m from 2 on the one with the least estimated cost is taken, however large.
    """
    h = h[np.lexsort((h, df))]
    alone, least = n - len(h), -(-6 * n // 7)
    m = np.arange(min(2, least), least + 1)
    ends = np.clip(m + (n - least) - alone, 0, len(h))
    posts = np.concatenate(([0], np.cumsum(np.sort(df).astype(np.float64) - 1)))[ends]
    cost = posts + posts / m ** 2 * (n / VERIFY)
    return h, int(m[np.argmin(cost)]), float(cost.min())


def sketch(h: np.ndarray) -> list[int]:
    """Bits, each flipped by every hash that falls on it: the sketches of two sets differ in no more
    bits than the sets in hashes."""
    bits = np.bincount(h & (64 * SKETCH - 1), minlength=64 * SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64).tolist()


def _ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["sid", "n", "part", "alone", "longer", "cost", "hs", *BITS]
    for batch in batches:
        out = []
        for sid, n, part, seen in zip(*(batch[c].to_pylist() for c in ("sid", "n", "part", "seen"))):
            h, m, cost = whole_prefix(n, np.array([s["df"] for s in seen]),
                                np.array([s["h"] for s in seen], np.int64))
            out.append((sid, n, part, n - len(h), m, cost, h, *sketch(h)))
        columns = list(zip(*out)) or [[]] * len(names)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(),
                 pa.list_(pa.int64()), *[pa.int64()] * SKETCH)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def meetings(sets: DataFrame) -> DataFrame:
    """A row for each hash at which two classes of different components meet that may link, from
    (sid, items, part): the pair's sids s and t, and m, the number of rows it needs."""
    rows = stage(sets.select("sid", "part", "items").mapInArrow(
        lambda it: batched(_items(it)), "h long, sid long, part long, n int"), "items")
    common = rows.groupBy("h").agg(
        F.least(F.count("*"), F.lit(FREQUENT)).cast("int").alias("df"), F.min("part").alias("p"),
        F.max("part").alias("q")).filter("p <> q").select("h", "df")
    ordered = stage(rows.join(common, "h").groupBy("sid", "n", "part").agg(
        F.collect_list(F.struct("h", "df")).alias("seen")).mapInArrow(
        _ordered, "sid long, n int, part long, alone int, longer int, cost double, hs array<long>, "
        + ", ".join(f"{b} long" for b in BITS)), "ordered")
    # A set meets larger ones with its own m and the prefix for it, and smaller ones with theirs.
    small, large = F.expr("n - ceil(6 * n / 7)"), F.expr("n - ceil(3 * n / 4)")

    def hashes(end):
        return F.slice("hs", 1, F.greatest(F.lit(0), end - F.col("alone")).cast("int"))
    # What asking for one match costs is counted: how many sets have a hash in their prefix for it.
    there = ordered.select(F.explode(hashes(large + 1)).alias("h")).groupBy("h").agg(
        F.count("*").alias("c"))
    once = ordered.select("sid", F.explode(hashes(small + 1)).alias("h")).join(there, "h").groupBy(
        "sid").agg(F.sum(F.col("c") - 1).alias("posts"))
    one = F.coalesce("posts", F.lit(0)) * (1 + F.col("n") / VERIFY)
    chosen = stage(ordered.join(once, "sid", "left").select(
        "sid", "n", "part", "alone", "hs", *BITS, F.when(one <= F.col("cost"), 1).otherwise(F.col("longer"))
        .cast("int").alias("m")), "chosen")
    most = chosen.agg(F.max("m")).first()[0] or 1  # one number

    def cut(end, *more):
        return chosen.select("sid", "n", "part", "m", *more, F.posexplode(hashes(end)).alias("i", "h"), "alone",
                             *BITS).withColumn("place", F.col("alone") + F.col("i") + 1).drop("i")
    x = cut(small + F.col("m")).alias("x")
    y = cut(large + most, large.alias("room")).alias("y")
    needed = F.ceil((F.col("x.n") + F.col("y.n")) * 3 / F.lit(7.0) - 1e-9)
    # Hashes that other components have, and how many of them one of the two sets lacks, at least.
    ours = F.col("x.n") - F.col("x.alone") + F.col("y.n") - F.col("y.alone")
    differ = sum((F.bit_count(F.col(f"x.{b}").bitwiseXOR(F.col(f"y.{b}"))) for b in BITS), F.lit(0))
    return x.join(y, "h").filter(
        (F.struct("x.n", "x.sid") < F.struct("y.n", "y.sid")) & (4 * F.col("x.n") >= 3 * F.col("y.n"))
        & (F.col("x.part") != F.col("y.part")) & (F.col("y.place") <= F.col("y.room") + F.col("x.m"))
        # What follows the first m matches of a pair is still enough for it.
        & (F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
           + F.col("x.m") >= needed)
        # The shared hashes are twice in ``ours`` and never among those that differ.
        & (ours - differ >= 2 * needed)).select(
        F.col("x.sid").alias("s"), F.col("y.sid").alias("t"), F.col("x.m").alias("m"))


def across(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes of different components that may link, from (sid, items, part)."""
    pairs = meetings(sets).groupBy("s", "t").agg(
        F.count("*").alias("c"), F.first("m").alias("m")).filter("c >= m")
    return pairs.select(F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b"))


def classed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, sid) per document, and per class its smallest doc_id."""
    digests = stage(docs.select("doc_id", "text").mapInArrow(
        _digests, "doc_id long, n_shingles long, sid long"), "digests")
    classes = stage(digests.filter("n_shingles > 0").groupBy("sid").agg(
        F.min("doc_id").alias("doc_id")), "classes")
    return digests, classes


def similar(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id: the smallest doc_id reachable by links.

    Documents without words have n_shingles 0 and link with nothing. Rows with a null doc_id take
    part in nothing and come back with their own null as component. Repeated rows link like
    copies. Of equal sets any number may exist: they are one class and never paired.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    digests, classes = classed(ids)
    links = class_links(ids.filter(F.col("doc_id").isNotNull()), classes)
    named = links.join(classes.select(F.col("sid").alias("a"), F.col("doc_id").alias("x")), "a") \
        .join(classes.select(F.col("sid").alias("b"), F.col("doc_id").alias("y")), "b") \
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    groups = components(named)
    roots = classes.join(groups, classes["doc_id"] == groups["id"], "left").select(
        "sid", F.coalesce("component", "doc_id").alias("root"))
    alone = digests.filter("n_shingles = 0").select("doc_id", "n_shingles",
                                                    F.col("doc_id").alias("component_id"))
    return digests.filter("n_shingles > 0").join(roots, "sid", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("root"))
        .alias("component_id")).unionByName(alone)


def one_per_group(docs: DataFrame) -> DataFrame:
    """Of each group of linked rows of ``docs`` one with the smallest doc_id stays.

    Rows are told apart by a number of their own, not by doc_id: rows that share an id or have none
    go only if their own text is linked with another row's. Ids that are null come last in a group,
    equal ones in the order of the numbers.
    """
    names = docs.columns
    # Written, so that the numbers are the same wherever they are read.
    rows = stage(docs.select(packed(docs).alias("row"),
                             F.monotonically_increasing_id().alias("_n")), "rows")
    groups = similar(rows.select(F.col("_n").alias("doc_id"), F.col("row.text").alias("text")))
    linked = groups.select(F.col("doc_id").alias("_m"), F.col("component_id").alias("_group"))
    linked = linked.join(rows.select("_n", F.col("row.doc_id").alias("_id")),
                         linked["_m"] == F.col("_n"))
    stays = linked.groupBy("_group").agg(F.min(F.struct(
        F.col("_id").isNull().alias("none"), "_id", "_m")).alias("first"))
    return unpacked(rows.join(stays.select(F.col("first._m").alias("_m")),
                              F.col("_n") == F.col("_m"), "left_semi"), "row", names)
