"""Document sets and the ways to write them."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsync import storage
from docsync.operators.buckets import BUCKETS, Buckets
from docsync.operators.ids import DOC_ID, ERRORS, WRITES, absent, first_per_id, last_per_id

# Ids of a batch are broadcast against the target up to this size, measured on the staged batch.
BROADCAST_BYTES = 64 * 1024 * 1024
# Memory of one broadcast id besides its text.
ROW_OVERHEAD = 64


@dataclass(frozen=True)
class Counts:
    """What became of the rows of one load. ``errors`` are documents with a value that does not fit
    their mapping: they are recorded, not stored."""

    created: int = 0
    conflicts: int = 0
    rejected: int = 0
    updated: int = 0
    errors: int = 0


class Target(Buckets):
    """One document set, unique by ``doc_id``."""

    def __init__(self, spark: SparkSession, root: str, name: str, sorted_ids: bool = False,
                 buckets: int = BUCKETS):
        super().__init__(spark, f"{root.rstrip('/')}/{name}", buckets)
        self.name = name
        self.sorted_ids = sorted_ids

    def ids(self, within=None) -> DataFrame:
        return self.read(within).select(DOC_ID)


def _as_is(docs: DataFrame, batch: DataFrame | None = None) -> DataFrame:
    return docs


def recreate(target: Target, batch: DataFrame, finish=_as_is, order=(), unique: bool = False,
             by: str | None = None) -> Counts:
    """Replace the target by the documents of a batch: one job, one pass over the source.

    ``finish(docs, batch)`` turns the rows that are kept into complete documents; ``batch`` is the
    staged batch they come from, None here.  The refused rows are counted by an observation in
    the last stage, whose tasks count once each even if they are repeated.
    """
    has_id = F.col(DOC_ID).isNotNull()
    seen = Observation()
    with target.lock():
        docs = target.laid_out(finish(first_per_id(batch, order, unique, by), None), True,
                               target.sorted_ids)
        docs = docs.observe(
            seen, F.coalesce(F.sum(F.when(has_id, F.col(WRITES))), F.lit(0)).alias("writes"),
            F.coalesce(F.sum(F.when(~has_id, F.col(WRITES))), F.lit(0)).alias("rejected"))
        stored = target.replace(docs.where(has_id).drop(WRITES))
    totals = seen.get
    return Counts(stored.documents, totals["writes"] - stored.documents - stored.failed,
                  totals["rejected"], errors=stored.failed)


@dataclass(frozen=True)
class _Size:
    ids: int
    writes: int
    rejected: int
    id_bytes: int
    first_id: str | None
    last_id: str | None
    buckets: list


@contextmanager
def _staged(target: Target, batch: DataFrame):
    """The batch as a written table, and its size, which the writing tasks have seen."""
    has_id, seen = F.col(DOC_ID).isNotNull(), Observation()
    batch = batch.observe(
        seen, F.count(DOC_ID).alias("ids"),
        F.coalesce(F.sum(F.when(has_id, F.col(WRITES))), F.lit(0)).alias("writes"),
        F.coalesce(F.sum(F.when(~has_id, F.col(WRITES))), F.lit(0)).alias("rejected"),
        F.coalesce(F.sum(F.octet_length(DOC_ID)), F.lit(0)).alias("id_bytes"),
        F.min(DOC_ID).alias("first_id"), F.max(DOC_ID).alias("last_id"),
        F.collect_set(F.when(has_id, target.bucket())).alias("buckets"))
    with storage.staged(batch, target.name) as rows:
        yield rows, _Size(**seen.get)


def create_if_absent(target: Target, batch: DataFrame, finish=_as_is, order=(),
                     unique: bool = False) -> Counts:
    """Insert the documents whose id is not in the target; the others are conflicts.

    The batch is staged once.  Of the target only the ids in the buckets of the batch, and within
    the range of its ids, are read.  A small batch is compared by broadcasting its ids, so the
    target is not shuffled; a large one by a shuffled anti join.  Only new rows go through
    ``finish``.
    """
    with target.lock():
        if not target.exists():
            return recreate(target, batch, finish, order, unique)
        with _staged(target, first_per_id(batch, order, unique)) as (rows, size):
            if size.ids == 0:
                return Counts(rejected=size.rejected)
            known = rows.where(F.col(DOC_ID).isNotNull())
            existing = target.ids(size.buckets).where(
                F.col(DOC_ID).between(size.first_id, size.last_id))
            if size.id_bytes + ROW_OVERHEAD * size.ids <= BROADCAST_BYTES:
                existing = existing.join(F.broadcast(known.select(DOC_ID)), DOC_ID, "left_semi")
            fresh = finish(absent(known, existing), known).drop(WRITES)
            stored = target.append(target.laid_out(fresh, ordered=target.sorted_ids))
    return Counts(stored.documents, size.writes - stored.documents - stored.failed, size.rejected,
                  errors=stored.failed)


def create_document(target: Target, document: dict) -> Counts:
    """Insert one document (a dict with its doc_id) if its id is not in the target.

    Fields the target knows are read by its types; only new ones are inferred, and a new field
    without a value is left out.
    """
    spark = target.spark
    known = {f.name: f for f in target.schema().fields} if target.exists() else {}
    document = {k: v for k, v in document.items() if k in known or v is not None}
    fields = [known[k] if k in known else T.StructField(
        k, spark.createDataFrame([Row(v=v)]).schema["v"].dataType) for k, v in document.items()]
    row = spark.createDataFrame([tuple(document.values())], T.StructType(fields))
    if DOC_ID not in row.columns:
        return Counts(rejected=1)
    return create_if_absent(target, row.withColumn(DOC_ID, F.col(DOC_ID).cast("string")))


def upsert(target: Target, batch: DataFrame, finish=_as_is, order=(),
           unique: bool = False) -> Counts:
    """Insert or update: the last row of an id counts instead of what the target holds.

    The buckets of the batch's ids are written anew; a batch without any known id is appended. A
    document whose new version has an error keeps its old one.
    """
    with target.lock(), _staged(target, last_per_id(batch, order, unique)) as (rows, size):
        if size.ids == 0 and target.exists():
            return Counts(rejected=size.rejected)
        known = rows.where(F.col(DOC_ID).isNotNull())
        docs = finish(known, known).drop(WRITES)
        if not target.exists():
            stored = target.replace(target.laid_out(docs, True, target.sorted_ids))
            return Counts(stored.documents, size.writes - size.ids, size.rejected,
                          errors=stored.failed)
        with storage.staged(docs, target.name) as done:
            failed, good = 0, done
            if ERRORS in done.columns:
                bad = F.size(ERRORS) > 0
                failed = target.append(target.laid_out(done.where(bad))).failed
                good = done.where(~bad).drop(ERRORS)
            updated = target.exchange(good.select(DOC_ID), good, target.sorted_ids)
    return Counts(size.ids - failed - updated, size.writes - size.ids, size.rejected, updated, failed)


def delete(target: Target, keys: DataFrame) -> int:
    """Remove the documents with the given ids; returns how many there were."""
    ids = keys.select(DOC_ID).where(F.col(DOC_ID).isNotNull()).distinct()
    with target.lock(), storage.staged(ids, target.name) as gone:
        return target.exchange(gone, ordered=target.sorted_ids)
