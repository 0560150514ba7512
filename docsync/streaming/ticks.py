"""Polling as a stream: the source emits time bounds, every micro-batch loads one window."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsync.functions.times import as_utc
from docsync.plans.flows import Home, sync_once
from docsync.spec import SyncSpec

# Fixed value: time between two polls.
POLL_INTERVAL = "5 seconds"


def register_ticks(spark: SparkSession) -> None:
    """Make the format ``ticks`` known to the session.

    Its offset is a time.  A micro-batch is one row (lo, hi): the end of the last batch and the
    present, or the option ``until`` for a bounded run.  Offsets go to the checkpoint, so a
    restart continues where the last run ended.  The reader only runs on the driver, and the
    classes are local so that it gets them by value.
    """
    from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

    class TickReader(SimpleDataSourceStreamReader):
        def __init__(self, options):
            self.start, self.until = options.get("start"), options.get("until")

        def _now(self):
            from datetime import datetime, timezone
            return datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")

        def initialOffset(self):
            return {"time": self.start or self._now()}

        def read(self, start):
            end = {"time": self.until or self._now()}
            return self.readBetweenOffsets(start, end), end

        def readBetweenOffsets(self, start, end):
            return iter([(start["time"], end["time"])] if start != end else [])

    class TickSource(DataSource):
        @classmethod
        def name(cls):
            return "ticks"

        def schema(self):
            return "lo string, hi string"

        def simpleStreamReader(self, schema):
            return TickReader(self.options)

    spark.dataSource.register(TickSource)


def ticks(spark: SparkSession, start=None, until=None) -> DataFrame:
    register_ticks(spark)
    reader = spark.readStream.format("ticks")
    if start is not None:
        reader = reader.option("start", as_utc(start).isoformat(sep=" "))
    if until is not None:
        reader = reader.option("until", as_utc(until).isoformat(sep=" "))
    return reader.load()


def follow(spark: SparkSession, home: Home, spec: SyncSpec, checkpoint: str, start=None,
           until=None, interval: str | None = None, on_report=None):
    """Start a query that keeps a target in step; one query per target.

    ``until`` loads the windows up to a fixed time and ends; without it the query polls every
    ``interval``.  The window begins at the saved refresh time and ends at the batch's tick, so
    a batch that is repeated after a failure loads nothing twice.
    """
    def load(batch: DataFrame, batch_id: int) -> None:
        hi = batch.agg(F.max("hi").alias("hi")).first()["hi"]  # one row per micro-batch
        if hi is not None:
            report = sync_once(spark, home, spec, hi)
            if on_report is not None:
                on_report(report)

    writer = (ticks(spark, start, until).writeStream.queryName(f"docsync-{spec.name}")
              .option("checkpointLocation", checkpoint).foreachBatch(load))
    if until is not None and interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval or POLL_INTERVAL)
    return writer.start()


def follow_all(spark: SparkSession, home: Home, specs, checkpoints: str, **options) -> list:
    """A query per target, each with a checkpoint of its own below the given folder."""
    return [follow(spark, home, spec, f"{checkpoints.rstrip('/')}/{spec.name}", **options)
            for spec in specs]


def status_frame(spark: SparkSession, queries) -> DataFrame:
    """(query, active, message, last_batch, error) of streaming queries."""
    rows = []
    for query in queries:
        progress, error = query.lastProgress, query.exception()
        if progress is not None and not isinstance(progress, dict):
            progress = json.loads(progress.json)
        rows.append((query.name, query.isActive, query.status["message"],
                     None if progress is None else progress["batchId"],
                     None if error is None else str(error)))
    return spark.createDataFrame(
        rows, "query string, active boolean, message string, last_batch bigint, error string")
