"""Packing of token pieces into sequences of fixed capacity.

Plans are made on the histogram of piece lengths, at most ``capacity`` rows however many
documents there are; equal lengths are interchangeable. Placing the pieces is a distributed
ranking within each length.

* ``configuration_plan``: configuration linear program by multiplicative weights, rounded.
* ``best_fit_plan``: best-fit decreasing with a segment tree over free capacities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from docsync.llm.common import packed, stage
from docsync.llm.tokens import pieces

CAPACITY = 2048
END_ID = 0
ROUNDS = 250
STEP = 0.5
#: Pieces of one length that are ranked in one group, about.
RANKED = 1 << 18


@dataclass
class Group:
    """``count`` sequences with the same content: how often each length occurs."""
    count: int
    content: tuple[tuple[int, int], ...]
    free: int


class CapacityTree:
    """Segment tree over free capacities 0..capacity; finds the least one with room."""

    def __init__(self, capacity: int):
        self.base = 1 << int(capacity).bit_length()
        self.any = np.zeros(2 * self.base, bool)

    def set(self, free: int, value: bool) -> None:
        at = self.base + free
        self.any[at] = value
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def least(self, size: int) -> int | None:
        """The smallest free capacity of at least ``size``, if there is one."""
        at = self.base + size
        if self.any[at]:
            return size
        while at > 1:
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.base:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.base
            at //= 2
        return None


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[Group]:
    """Best-fit decreasing: each piece, longest first, goes where it leaves the least room.

    Equal pieces go in bulk: a sequence that is the best fit for one piece stays the best fit
    until the next equal piece no longer fits.
    """
    tree = CapacityTree(capacity)
    room: dict[int, list[Group]] = {}

    def put(group: Group) -> None:
        if group.free not in room:
            room[group.free] = []
            tree.set(group.free, True)
        room[group.free].append(group)

    def used(group: Group, count: int, length: int, many: int) -> Group:
        return Group(count, group.content + ((length, many),), group.free - length * many)

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            free = tree.least(length)
            if free is None:
                group = Group(-(-left // (capacity // length)), (), capacity)
            else:
                group = room[free].pop()
                if not room[free]:
                    del room[free]
                    tree.set(free, False)
            many = group.free // length
            full = min(group.count, left // many)
            if full:
                put(used(group, full, length, many))
            left -= full * many
            rest = group.count - full
            if rest and left and full * many + left < group.count * many:
                put(used(group, 1, length, left))
                left, rest = 0, rest - 1
            if rest:
                put(Group(rest, group.content, group.free))
    return [g for groups in room.values() for g in groups]


def best_configuration(value: np.ndarray, capacity: int) -> dict[int, int]:
    """The multiset of lengths of most value that fits: an unbounded knapsack.

    ``value[l]`` is the value of length l; 0 where there is no piece of it.
    """
    best = np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        sums = value[c:0:-1] + best[:c]  # lengths c, c - 1, ...: of equals the longest wins
        k = int(sums.argmax())
        if sums[k] > best[c - 1]:
            best[c], choice[c] = sums[k], c - k
        else:
            best[c] = best[c - 1]
    out: dict[int, int] = {}
    c = capacity
    while c > 0:
        if choice[c]:
            out[int(choice[c])] = out.get(int(choice[c]), 0) + 1
            c -= int(choice[c])
        else:
            c -= 1
    return out


def configuration_plan(counts: dict[int, int], capacity: int) -> list[Group]:
    """Covering LP over configurations (multisets of lengths that fit one sequence).

    Multiplicative weights: every length has a weight, at first its share of all tokens; each round
    the knapsack finds the configuration of most weight per piece, takes as many of it as its
    scarcest length allows, and lowers the weights of what it covers. The fractional counts are
    scaled to cover all tokens once and rounded down, longest pieces first, as far as pieces
    remain; configurations with free room are left to the last step, in which best fit packs what
    is left over.
    """
    counts = {length: n for length, n in counts.items() if n}
    left = dict(counts)
    if counts:
        n = np.zeros(capacity + 1)
        for length, many in counts.items():
            n[length] = many
        there = n > 0
        weight = n * np.arange(capacity + 1)
        amounts: dict[tuple, float] = {}
        for _ in range(ROUNDS):
            value = np.divide(weight, n, out=np.zeros_like(weight), where=there)
            found = best_configuration(value, capacity)
            found = {length: min(k, counts[length]) for length, k in found.items()}
            taken = min(counts[length] / k for length, k in found.items())
            key = tuple(sorted(found.items(), reverse=True))
            amounts[key] = amounts.get(key, 0.0) + taken
            for length, k in found.items():
                weight[length] *= 1 - STEP * k * taken / n[length]
            weight /= weight.max()
        covered = sum(x * sum(length * k for length, k in c) for c, x in amounts.items())
        scale = sum(length * m for length, m in counts.items()) / covered
        plan = []
        for config, x in sorted(amounts.items(), key=lambda e: -e[0][0][0]):
            free = capacity - sum(length * k for length, k in config)
            many = min([int(x * scale)] + [left[length] // k for length, k in config])
            if many > 0 and not free:
                for length, k in config:
                    left[length] -= many * k
                plan.append(Group(many, config, free))
    else:
        plan = []
    return plan + best_fit_plan({length: m for length, m in left.items() if m}, capacity)


def _runs(plan: list[Group]) -> tuple[np.ndarray, ...]:
    """Where the ranks of each length go: sorted (key, first rank, sequence, per sequence, offset)."""
    rows, sequence, given = [], 0, {}
    for group in plan:
        offset = 0
        for length, many in group.content:
            first = given.get(length, 0)
            rows.append((length, first, sequence, many, offset))
            given[length] = first + group.count * many
            offset += length * many
        sequence += group.count
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return (table[:, 0] << 40) + table[:, 1], table


def _placed(keys: np.ndarray, table: np.ndarray):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = np.asarray(batch["length"]), np.asarray(batch["rank"])
            run = table[np.searchsorted(keys, (length << 40) + rank, side="right") - 1]
            beyond = rank - run[:, 1]
            many = run[:, 3]
            columns = [batch[c] for c in batch.schema.names if c not in ("rank",)]
            names = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(run[:, 2] + beyond // many),
                           pa.array(run[:, 4] + beyond % many * length)],
                names + ["sequence_id", "offset"])
    return place


def _ranked(cut: DataFrame, tails: int) -> DataFrame:
    """Pieces shorter than a sequence with their rank among those of the same length.

    Ranks count within (length, bucket) groups of bounded size, which start where the buckets
    before them end; so a length that a third of all pieces have is many groups.
    """
    buckets = max(1, tails // RANKED)
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = cut.groupBy("length", "bucket").agg(F.count("*").alias("many")).select(
        "length", "bucket", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("from"))
    order = Window.partitionBy("length", "bucket").orderBy("id")
    ranked = cut.withColumn("within", F.row_number().over(order) - 1)
    return ranked.join(starts, ["length", "bucket"]).withColumn(
        "rank", F.col("from") + F.col("within")).drop("bucket", "from", "within")


def placed(docs: DataFrame, path: str, planner=configuration_plan, carry: list[str] | None = None,
           capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every piece of every document: struct ``row`` (columns ``carry``, default all but text),
    piece, start, length, ids_crc32, [ids as little-endian 16 or 32-bit numbers,] sequence_id,
    offset.

    Only documents longer than ``capacity`` are cut, into pieces of ``capacity`` and a shorter
    last one. A null or empty text is its end id alone. Repeated rows are packed like others;
    which of equal lengths goes where has no meaning but is the same in each run over the same
    staged rows. An empty table gives no rows.
    """
    names = [c for c in docs.columns if c != "text"] if carry is None else carry
    rows = docs.select(packed(docs.select(*names)).alias("row"), docs["text"].alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    schema = (f"row {kind}, piece int, start long, length long, ids_crc32 long"
              + ", ids binary" * with_ids)
    cut = rows.mapInArrow(pieces(path, capacity, END_ID, with_ids), schema)
    cut = stage(cut.withColumn("id", F.monotonically_increasing_id()), "pieces")
    counts = dict(cut.groupBy("length").count().collect())  # at most ``capacity`` rows
    counts.pop(capacity, None)
    # A full piece is a sequence of its own; negative ids keep those apart.
    full = cut.filter(F.col("length") == capacity).withColumns({
        "sequence_id": -1 - F.col("id"), "offset": F.lit(0).cast("long")})
    tails = cut.filter(F.col("length") < capacity).select("id", "length")
    keys, table = _runs(planner(counts, capacity))
    spots = _ranked(tails, sum(counts.values())).select("id", "length", F.col("rank").cast("long")) \
        .mapInArrow(_placed(keys, table), "id long, length long, sequence_id long, offset long")
    short = cut.filter(F.col("length") < capacity).join(spots.drop("length"), "id")
    columns = [c for c in cut.columns if c != "id"] + ["sequence_id", "offset"]
    return short.select(*columns).unionByName(full.select(*columns))


def _joined(ids: bytes, length: int, width: str) -> bytes:
    """A piece's ids in the width of the matrix."""
    held = np.frombuffer(ids, "<u2" if len(ids) == 2 * length else "<u4")
    if len(held) and int(held.max()) > np.iinfo(width).max:
        raise ValueError(f"token id {held.max()} does not fit the matrix's {width}")
    return held.astype(width).tobytes()


def _rows(capacity: int, width: str = "<u2"):
    size, place_width = np.dtype(width).itemsize, "<u2" if capacity <= 1 << 16 else "<u4"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths, positions, used = [], [], [], []
            for parts in batch["parts"].to_pylist():
                parts.sort(key=lambda p: p["offset"])
                flat = b"".join(_joined(p["ids"], p["length"], width) for p in parts)
                ends = np.cumsum([p["length"] for p in parts])
                place = np.concatenate([np.arange(p["length"]) for p in parts])
                rest = capacity - int(ends[-1])
                ids.append(flat + bytes(size * rest))
                positions.append(np.append(place, np.zeros(rest, int)).astype(place_width).tobytes())
                lengths.append([0] + ends.tolist())
                used.append(int(ends[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch["sequence_id"], pa.array(used, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(lengths, pa.list_(pa.int32())), pa.array(positions, pa.binary()),
                 batch["doc_ids"]],
                ["sequence_id", "n_tokens", "ids", "cu_seqlens", "position_ids", "doc_ids"])
    return build


def id_width(path: str) -> str:
    from tokenizers import Tokenizer
    most = max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values(), default=0)
    return "<u2" if most < 1 << 16 else "<u4"


def matrices(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Packed training rows: one per sequence, by best-fit decreasing.

    ids: ``capacity`` little-endian token ids, zeros after ``n_tokens``, of 16 bits where the
    vocabulary fits them and else of 32; cu_seqlens: 0 and the end of each segment; position_ids:
    positions that start anew with each segment, of 32 bits beyond a capacity of 65536; doc_ids: the
    document and piece of each segment. A document's pieces joined in order are its ids, so nothing
    is lost.
    """
    out = placed(docs, path, best_fit_plan, ["doc_id"], capacity, with_ids=True)
    kind = out.schema["row"].dataType["doc_id"].dataType.simpleString()
    parts = F.array_sort(F.collect_list(F.struct(
        "offset", "length", "ids", F.col("row.doc_id").alias("doc_id"), "piece")))
    rows = out.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.transform("parts", lambda p: p.dropFields("doc_id", "piece"))
        .alias("parts"),
        F.transform("parts", lambda p: F.struct(p["doc_id"], p["piece"])).alias("doc_ids"))
    return rows.mapInArrow(_rows(capacity, id_width(path)), (
        "sequence_id long, n_tokens long, ids binary, cu_seqlens array<int>, position_ids binary,"
        f" doc_ids array<struct<doc_id:{kind},piece:int>>"))


def write_matrices(docs: DataFrame, path: str, folder: str, capacity: int = CAPACITY) -> None:
    """The packed rows as Parquet files: fixed-width id and position rows and segment ends."""
    matrices(docs, path, capacity).write.mode("overwrite").parquet(folder)


def pack(docs: DataFrame, path: str) -> DataFrame:
    """The pieces of ``docs`` with doc_id, packed by the configuration program."""
    out = placed(docs, path, carry=["doc_id"])
    return out.select(F.col("row.doc_id").alias("doc_id"),
                      *[c for c in out.columns if c != "row"])
