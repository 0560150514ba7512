"""The flows of a document set: full load, change window, repair, delete."""

from __future__ import annotations

import zlib
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsync import storage
from docsync.functions.times import as_utc, utc_now, window_start
from docsync.operators import target as targets
from docsync.operators.digests import RANGES, differences
from docsync.operators.document import apply_mapping, split_errors
from docsync.operators.enrich import batch_rows, enrich
from docsync.operators.ids import DOC_ID, WRITES, absent, first_per_id, native_id, with_doc_id
from docsync.operators.state import RefreshState
from docsync.operators.target import Counts, Target
from docsync.sources import sql
from docsync.spec import SyncSpec


class Home:
    """The folder that holds the targets and their refresh state."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.state = RefreshState(spark, self.root)

    def target(self, spec: SyncSpec | str) -> Target:
        if isinstance(spec, str):
            return Target(self.spark, self.root, spec)
        return Target(self.spark, self.root, spec.name, spec.sorted_ids, spec.buckets)


@dataclass(frozen=True)
class Report:
    """One run of a flow.  status is done, skipped or cancelled; reason says why not done."""

    index_name: str
    flow: str
    status: str = "done"
    reason: str | None = None
    lo: datetime | None = None
    hi: datetime | None = None
    counts: Counts = field(default_factory=Counts)
    deleted: int = 0


SUPERSEDED = "a full load took its place"

_REPORT = ("index_name string, flow string, status string, reason string, lo timestamp_ntz, "
           "hi timestamp_ntz, created bigint, conflicts bigint, rejected bigint, updated bigint, "
           "deleted bigint, errors bigint")


def report_frame(spark: SparkSession, reports) -> DataFrame:
    """The run reports (one row per run) as a DataFrame."""
    rows = [(r.index_name, r.flow, r.status, r.reason, r.lo, r.hi, r.counts.created,
             r.counts.conflicts, r.counts.rejected, r.counts.updated, r.deleted,
             r.counts.errors) for r in reports]
    return spark.createDataFrame(rows, _REPORT)


# How often a full load has pushed a sync of a target aside, by the target's folder.
_SUPERSEDED: Counter = Counter()


def sync_tag(target: Target) -> str:
    """The tag of the jobs that sync a target; ``SparkContext.cancelJobsWithTag`` ends them."""
    return f"docsync-sync-{zlib.crc32(target.path.encode()):08x}-{target.name.replace(',', '_')}"


@contextmanager
def _pool(spark: SparkSession, name: str, tag: str | None = None):
    """Jobs run in a scheduler pool of the target, so that with ``spark.scheduler.mode`` FAIR a large
    load does not hold up the windows of other targets."""
    context = spark.sparkContext
    before = context.getLocalProperty("spark.scheduler.pool")
    context.setLocalProperty("spark.scheduler.pool", before or f"docsync-{name}")
    if tag:
        context.addJobTag(tag)
    try:
        yield
    finally:
        if tag:
            context.removeJobTag(tag)
        context.setLocalProperty("spark.scheduler.pool", before)


def documents(rows: DataFrame, spec: SyncSpec) -> DataFrame:
    return with_doc_id(rows, spec.id_columns, spec.id_separator)


def complete(spark: SparkSession, spec: SyncSpec, docs: DataFrame,
             batch: DataFrame | None = None, errors: bool = False) -> DataFrame:
    """Enrichment and mapping.  With a batch, only its extension rows are grouped; with ``errors``
    values that do not fit the mapping are told in a column instead of ending the run."""
    ext = sql.extension_rows(spark, spec)
    if ext is not None and batch is not None:
        ext = batch_rows(ext, batch, spec.extension_column)
    if not spec.mapping:
        return enrich(docs, ext, spec)
    if ext is not None and spec.fields_mode == "flatten" and spec.ext_keys:
        # A custom field may take the place of one: the own values of the other documents are
        # written as declared before they become text.
        docs = apply_mapping(docs, spec.mapping, False, fields=spec.ext_keys, errors=errors)
    return apply_mapping(enrich(docs, ext, spec), spec.mapping, analyzers=spec.analyzers,
                         errors=errors)


def _finish(spark: SparkSession, spec: SyncSpec):
    return lambda docs, batch=None: complete(spark, spec, docs, batch, spec.unfit == "record")


def init(spark: SparkSession, home: Home, spec: SyncSpec, now=None) -> Report:
    """Load everything changed before ``now`` into a new target, then record ``now``.

    The old target stays readable until the new one is complete.  The refresh time is removed
    first and saved last, so a failed load leaves a target that sync refuses to continue.  A sync of
    this target that is running in this application is cancelled; syncs of other targets go on.
    """
    now = as_utc(now or utc_now())
    target = home.target(spec)
    _SUPERSEDED[target.path] += 1
    spark.sparkContext.cancelJobsWithTag(sync_tag(target))
    with target.lock(), _pool(spark, spec.name):
        home.state.delete(spec.name)
        batch = documents(sql.full(spark, spec, now), spec)
        counts = targets.recreate(target, batch, _finish(spark, spec), spec.order,
                                  spec.unique_ids, native_id(batch, spec.id_columns))
        home.state.save(spec.name, now)
    return Report(spec.name, "init", hi=now, counts=counts)


def _write(spark: SparkSession, home: Home, spec: SyncSpec, batch: DataFrame) -> Counts:
    write = targets.upsert if spec.op == "upsert" else targets.create_if_absent
    return write(home.target(spec), batch, _finish(spark, spec), spec.order, spec.unique_ids)


def sync_once(spark: SparkSession, home: Home, spec: SyncSpec, now=None) -> Report:
    """Load one change window: from the last refresh minus the lookback up to ``now``, both ends
    excluded.  Needs a target and a refresh time.

    The refresh time moves after the write, so a failed run is repeated by the next one, and
    repeating a window changes nothing.
    """
    if not home.target(spec).exists():
        return Report(spec.name, "sync", "skipped", "target does not exist; run init first")
    last = home.state.find(spec.name)
    if last is None:
        return Report(spec.name, "sync", "skipped", "no refresh time; run init first")
    now = as_utc(now or utc_now())
    if now <= last:
        return Report(spec.name, "sync", "skipped", "the window is empty", last, now)
    lo = window_start(last, spec.lookback)
    target = home.target(spec)
    loads = _SUPERSEDED[target.path]
    try:
        with target.lock(), _pool(spark, spec.name, sync_tag(target)):
            if _SUPERSEDED[target.path] != loads or home.state.find(spec.name) != last:
                return Report(spec.name, "sync", "cancelled", SUPERSEDED, lo, now)
            batch = documents(sql.window(spark, spec, lo, now), spec)
            counts = _write(spark, home, spec, batch)
            if _SUPERSEDED[target.path] != loads:
                return Report(spec.name, "sync", "cancelled", SUPERSEDED, lo, now)
            home.state.save(spec.name, now)
            target.merge(spec.max_parts, spec.sorted_ids)
    except Exception:
        if _SUPERSEDED[target.path] == loads:
            raise
        return Report(spec.name, "sync", "cancelled", SUPERSEDED, lo, now)
    return Report(spec.name, "sync", lo=lo, hi=now, counts=counts)


def fix(spark: SparkSession, home: Home, spec: SyncSpec, keys, now=None) -> Report:
    """Reload the rows with the given key values; neither target nor refresh time is reset."""
    now = as_utc(now or utc_now())
    batch = documents(sql.by_keys(spark, spec, now, keys), spec)
    counts = _write(spark, home, spec, batch)
    if counts == Counts():
        raise ValueError(f"{spec.name}: no row has the keys {keys}")
    return Report(spec.name, "fix", hi=now, counts=counts)


def repair_missing(spark: SparkSession, home: Home, spec: SyncSpec, now=None) -> Report:
    """Load every row changed before ``now`` whose document is not in the target."""
    now = as_utc(now or utc_now())
    batch = documents(sql.full(spark, spec, now), spec)
    target = home.target(spec)
    if target.exists():
        batch = absent(batch, target.ids())
    counts = targets.create_if_absent(target, batch, _finish(spark, spec), spec.order,
                                      spec.unique_ids)
    return Report(spec.name, "repair", hi=now, counts=counts)


def expected(spark: SparkSession, spec: SyncSpec, now=None) -> DataFrame:
    """The documents that a full load up to ``now`` would store."""
    batch = documents(sql.full(spark, spec, as_utc(now or utc_now())), spec)
    docs = first_per_id(batch.where(F.col(DOC_ID).isNotNull()), spec.order, spec.unique_ids,
                        native_id(batch, spec.id_columns))
    return split_errors(_finish(spark, spec)(docs).drop(WRITES))[0]


def verify(spark: SparkSession, home: Home, spec: SyncSpec, now=None) -> DataFrame:
    """(doc_id, kind) of what distinguishes the target from the source: missing, orphan, changed.

    Source and target are compared by sums of ranges; documents of ranges that agree are neither
    shuffled nor joined.
    """
    target = home.target(spec)
    buckets = target.buckets_there()
    ranges = max(1, RANGES // buckets) * buckets  # so that a range lies in one folder

    def folders(differ):
        return target.read({r % buckets for r in differ})
    return differences(expected(spark, spec, now), target.read(), ranges=ranges, folders=folders)


def repair_differences(spark: SparkSession, home: Home, spec: SyncSpec, now=None) -> Report:
    """Bring the target to what ``verify`` expects: documents that are missing or changed are loaded
    anew, orphans are removed."""
    now = as_utc(now or utc_now())
    target = home.target(spec)
    with storage.staged(verify(spark, home, spec, now), f"{spec.name}-differences") as found:
        orphans = found.where("kind = 'orphan'").select(DOC_ID)
        stale = found.where("kind in ('missing', 'changed')").select(DOC_ID)
        deleted = targets.delete(target, orphans)
        batch = documents(sql.full(spark, spec, now), spec).join(stale, DOC_ID, "left_semi")
        # Of rows with one id the first counts, as in a full load.
        first = first_per_id(batch, spec.order, spec.unique_ids).drop(WRITES)
        counts = targets.upsert(target, first, _finish(spark, spec), unique=True)
    return Report(spec.name, "repair", hi=now, counts=counts, deleted=deleted)


def delete_once(spark: SparkSession, home: Home, spec: SyncSpec) -> Report:
    """Remove the documents whose keys the spec's delete SQL returns (an extension)."""
    if spec.delete_sql is None:
        return Report(spec.name, "delete", "skipped", "the spec has no delete_sql")
    if not home.target(spec).exists():
        return Report(spec.name, "delete", "skipped", "target does not exist; run init first")
    keys = documents(sql.deleted_keys(spark, spec), spec)
    return Report(spec.name, "delete", deleted=targets.delete(home.target(spec), keys))


def run_all(spark: SparkSession, home: Home, specs, flow, now=None, parallel: int = 1):
    """Run a flow (init, sync_once, ...) for every spec; ``parallel`` of them at a time.

    The jobs share one session, so several small targets fill the cluster together.
    """
    now = as_utc(now or utc_now())
    specs = list(specs)
    if parallel <= 1:
        return [flow(spark, home, spec, now) for spec in specs]
    with ThreadPoolExecutor(parallel) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(flow), spark, home, spec, now)
                for spec in specs]
        return [run.result() for run in runs]


__all__ = ["Home", "Report", "complete", "delete_once", "documents", "fix", "init",
           "expected", "repair_differences", "repair_missing", "report_frame", "run_all", "sync_once",
           "verify"]
