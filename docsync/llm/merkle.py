"""Merkle manifest of a dataset: a hash tree per source, and one over the sources.

Parents keep a copy of their SHA-256 state from before each child's slot. Folding a changed child
into its parent resumes the state of its slot with the replacement and the siblings on its right;
what lies on its left is never hashed again.

Nodes are numbered within their source over all tasks (range partitions, then counts of earlier
partitions). Blocks of ``BLOCK`` consecutive nodes are ``LEVELS`` levels of the tree, so a source of
any size is many groups of bounded size. Their tops are the nodes of the next tier, which is
``BLOCK`` times smaller. Afterwards the way from a block's top to the root comes down tier by tier,
one row per block.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsync.llm.common import drop, stage

FAN = 16
LEVELS = 2
#: Nodes of a block: one group, in one task.
BLOCK = FAN ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_MEMBER = "g string, block long, pos long, last long, digest string"


class Parent:
    """A node over ``children`` (digests as hex text) with the state before each child's slot."""

    def __init__(self, children: list[bytes]):
        self.children, self.states = children, []
        state = hashlib.sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def folded(self, slot: int, child: bytes) -> bytes:
        """The digest with another child in ``slot``."""
        state = self.states[slot].copy()
        state.update(child)
        for sibling in self.children[slot + 1:]:
            state.update(sibling)
        return state.hexdigest().encode()

    def siblings(self, slot: int) -> bytes:
        return b"".join(self.children[:slot] + self.children[slot + 1:])


def parents(nodes: list[bytes], whole: bool) -> list[list[Parent]]:
    """Levels of parents over one block. ``whole``: it is all that its group has, so its tree ends
    with one node; a part of a group has all its levels."""
    levels = []
    while len(levels) < LEVELS and (not whole or len(nodes) > 1):
        levels.append([Parent(nodes[i:i + FAN]) for i in range(0, len(nodes), FAN)])
        nodes = [p.digest for p in levels[-1]]
    return levels


def _steps(slot: int, levels: list[list[Parent]]):
    """(parent, slot) on the way from a block's node up to its top."""
    for level in levels:
        yield level[slot // FAN], slot % FAN
        slot //= FAN


def _written(parent: Parent, slot: int) -> str:
    return f"{slot:02d}" + b"".join(parent.children).decode()


def _read(step: str) -> tuple[Parent, int]:
    run = step[2:].encode()
    return Parent([run[i:i + 64] for i in range(0, len(run), 64)]), int(step[:2])


def _block(members: pa.Table):
    members = members.sort_by("pos")
    nodes = [d.encode() for d in members["digest"].to_pylist()]
    return members, nodes, parents(nodes, members["last"][0].as_py() == 0)


def _top(members: pa.Table) -> pa.Table:
    """The top of one block, as a node of the next tier."""
    members, nodes, levels = _block(members)
    digest = levels[-1][0].digest if levels else nodes[0]
    block, last = members["block"][0].as_py(), members["last"][0].as_py()
    return pa.table([[members["g"][0].as_py()], [block // BLOCK], [block], [last // BLOCK],
                     [digest.decode()], [last == 0]],
                    names=["g", "block", "pos", "last", "digest", "whole"])


def _ways(members: pa.Table, above: pa.Table) -> pa.Table:
    """Of every node of a block its way to the root: subroot and root, then the steps. Nodes with a
    key are subroots themselves."""
    members, nodes, levels = _block(members)
    way = above["way"][0].as_py()
    out = []
    for slot, (node, key) in enumerate(zip(nodes, members["key"].to_pylist())):
        own = [_written(*s) for s in _steps(slot, levels)]
        out.append([way[0] if key is None else node.decode(), way[1], *own, *way[2:]])
    return pa.table([members["g"], members["key"], members["pos"], pa.array(out, pa.list_(pa.string()))],
                    names=["g", "key", "pos", "way"])


def _proofs(members: pa.Table, above: pa.Table) -> pa.Table:
    """Proof, folded root and verdict of every leaf of a block."""
    members, nodes, levels = _block(members)
    subroot, root, *rest = above["way"][0].as_py()
    upper = [_read(s) for s in rest]
    shared = b"".join(p.siblings(slot) for p, slot in upper)
    proofs, roots = [], []
    for slot, (node, changed) in enumerate(zip(nodes, members["changed"].to_pylist())):
        proof, now = hashlib.sha256(), changed.encode() if changed else node
        for parent, at in _steps(slot, levels):
            proof.update(parent.siblings(at))
            now = parent.folded(at, now)
        for parent, at in upper:
            now = parent.folded(at, now)
        proof.update(shared)
        proofs.append(proof.hexdigest())
        roots.append(now.decode())
    n = len(nodes)
    return pa.table([members["doc_id"], members["digest"], pa.array([subroot] * n, pa.string()),
                     pa.array([root] * n, pa.string()), pa.array(proofs, pa.string()),
                     pa.array(roots, pa.string()), pa.array([r == root for r in roots], pa.bool_())],
                    names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                           "verified"])


def _leaf(fields: list[Column]) -> Column:
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(
        F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, their place within ``g`` by ``order``, with their block and the
    number of their group's last block. Written; ``rows`` must be written too."""
    at = stage(rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
               .withColumn("at", F.monotonically_increasing_id())
               .withColumn("part", F.shiftright("at", 33)), "sorted")
    runs = at.groupBy("g", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    own = Window.partitionBy("g")  # a row per range partition
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("g", "part", (F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0)))
                       .alias("shift"), F.sum("n").over(own).alias("size"))
    pos = F.col("at") - F.col("shift")
    out = stage(at.join(runs, ["g", "part"]).select(
        *rows.columns, pos.alias("pos"), F.floor(pos / BLOCK).cast("long").alias("block"),
        F.floor((F.col("size") - 1) / BLOCK).cast("long").alias("last")), "numbered")
    drop(at)
    return out


def tiers(members: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(nodes of each tier, tops (g, digest) of the groups). A tier has a row for every BLOCK rows
    of the tier before, so their number is a logarithm."""
    out, tops = [members], []
    while True:
        found = stage(out[-1].select("g", "block", "pos", "last", "digest").groupBy("g", "block")
                      .applyInArrow(_top, _MEMBER + ", whole boolean"), "tier")
        tops.append(found.filter("whole").select("g", "digest"))
        more = found.filter("not whole")
        if more.isEmpty():
            break
        out.append(more.withColumn("key", F.lit(None).cast("string")))
    top = tops[0]
    for t in tops[1:]:
        top = top.unionByName(t)
    return out, top


def _above(tier: DataFrame, ways: DataFrame | None, starts: DataFrame) -> DataFrame:
    """Ways of a tier's blocks: of groups that end here the group's own, else those of the tier
    above, whose nodes are the blocks."""
    own = starts.join(tier.filter("last = 0").select("g").distinct(), "g", "left_semi").select(
        "g", F.lit(0).cast("long").alias("block"), "way")
    if ways is not None:
        own = own.unionByName(ways.select("g", F.col("pos").alias("block"), "way"))
    return own.toDF("g", "block", "way")  # columns apart from the tier's, which may be one table


def _down(levels: list[DataFrame], starts: DataFrame, last) -> DataFrame:
    """Bring the ways down from the groups' tops; ``last`` does the lowest tier."""
    ways = None
    for tier in reversed(levels[1:]):
        ways = stage(_ways_of(tier, _above(tier, ways, starts)), "ways")
    return last(levels[0], _above(levels[0], ways, starts))


def _ways_of(tier: DataFrame, above: DataFrame) -> DataFrame:
    return tier.select("g", "block", "pos", "last", "digest", "key").groupBy("g", "block").cogroup(
        above.groupBy("g", "block")).applyInArrow(
        _ways, "g string, key string, pos long, way array<string>")


def _proofs_of(tier: DataFrame, above: DataFrame) -> DataFrame:
    return tier.select("g", "block", "pos", "last", "digest", "doc_id", "changed").groupBy(
        "g", "block").cogroup(above.groupBy("g", "block")).applyInArrow(
        _proofs, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                 "folded_root string, verified boolean")


def manifest(docs: DataFrame, changed_text: Column | None = None) -> DataFrame:
    """Leaf, subroot, root, proof and the root folded from a tampered leaf, for every row.

    ``changed_text`` is the text that is folded in; null, or none given: the row's own.

    A null field enters a leaf as ``-``, so null and empty texts differ. A null source is a source
    of its own, before all others; null ids come first in their source. Rows with equal ids are
    ordered by their leaves, and repeated rows are leaves of their own. No rows give no rows.
    Columns besides FIELDS take no part.
    """
    fields = [F.col("doc_id").cast("long"), *[F.col(c) for c in FIELDS[1:]]]
    changed = F.lit(None).cast("string")
    if changed_text is not None:
        changed = F.when(changed_text.isNotNull(), _leaf([*fields[:-1], changed_text]))
    rows = stage(docs.select(
        # Texts that sort like the sources, null first.
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")).alias("g"),
        fields[0].alias("doc_id"), _leaf(fields).alias("digest"), changed.alias("changed"),
        F.monotonically_increasing_id().alias("_n")), "leaves")
    leaves = numbered(rows, ["doc_id", "digest", "_n"])
    drop(rows)
    trees, subroots = tiers(leaves)
    sources = numbered(stage(subroots.select(F.lit("").alias("g"), F.col("g").alias("key"),
                                             "digest"), "subroots"), ["key"])
    over, roots = tiers(sources)
    starts = roots.select("g", F.array(F.lit(""), "digest").alias("way"))
    ways = stage(_down(over, starts, _ways_of), "ways")
    return _down(trees, ways.select(F.col("key").alias("g"), "way"), _proofs_of)


def tampered_text() -> Column:
    """The text in lower case (A to Z only) where 5 divides crc32 of the id; else null."""
    hit = F.crc32(F.encode(F.col("doc_id").cast("long").cast("string"), "utf-8")) % 5 == 0
    return F.when(hit, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                   "abcdefghijklmnopqrstuvwxyz"))
