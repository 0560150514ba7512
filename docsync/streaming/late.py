"""A change feed whose late rows are kept apart instead of being lost."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsync import storage
from docsync.functions.times import as_utc, time_literal, utc_text
from docsync.operators.ids import with_doc_id
from docsync.operators.target import Counts, Target, create_if_absent

_BATCH = "late_in_batch"


@dataclass(frozen=True)
class FeedReport:
    """One micro-batch: rows = kept + repeats + rejected + late."""

    batch: int
    watermark: datetime | None
    kept: int
    repeats: int
    rejected: int
    late: int


class LateRows:
    """The side output of a feed: a folder for each micro-batch that had late rows, and the event
    time that the feed has reached."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _state(self) -> dict:
        name = f"{self.path}/_reached.json"
        return json.loads(storage.read_text(self.spark, name)) if storage.exists(self.spark, name) else {}

    def reached(self, batch: int) -> datetime | None:
        """The newest event time before a micro-batch, the same when the batch is repeated."""
        state = self._state()
        at = state.get("before" if state.get("batch") == batch else "after")
        return None if at is None else as_utc(at)

    def move(self, batch: int, before: datetime | None, newest: datetime | None) -> None:
        after = max((t for t in (before, newest) if t is not None), default=None)
        text = [None if t is None else t.isoformat() for t in (before, after)]
        storage.write_text(self.spark, f"{self.path}/_reached.json",
                           json.dumps({"batch": batch, "before": text[0], "after": text[1]}))

    def put(self, batch: int, rows: DataFrame) -> None:
        """Rows of one micro-batch, in place of what an interrupted run of it left."""
        rows.write.mode("overwrite").parquet(f"{self.path}/{_BATCH}={batch}")

    def batches(self) -> list[int]:
        names = storage.folders(self.spark, self.path)
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{_BATCH}="))

    def read(self, schema: T.StructType) -> DataFrame:
        """Late rows with the number of their micro-batch."""
        schema = T.StructType([*schema.fields, T.StructField(_BATCH, T.LongType())])
        if not self.batches():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def drop(self, batches) -> None:
        for batch in batches:
            storage.delete(self.spark, f"{self.path}/{_BATCH}={batch}")


def load_batch(target: Target, late: LateRows, rows: DataFrame, batch: int, time_column: str,
               lookback: timedelta) -> FeedReport:
    """Load the rows of one micro-batch (with doc_id): on time into the target, each id once; late
    ones into the side output.

    A row is late when its time lies before the newest time of all earlier batches minus the
    lookback. A row without a time is on time. A batch that is repeated after a failure decides in
    the same way and stores nothing twice.
    """
    before = late.reached(batch)
    watermark = None if before is None else before - lookback
    kind = rows.schema[time_column].dataType
    is_late = F.lit(False) if watermark is None else F.coalesce(
        F.col(time_column) < time_literal(watermark, kind), F.lit(False))
    with storage.staged(rows.withColumn("_late", is_late), target.name) as told:
        newest, n_late = told.agg(utc_text(F.max(time_column)), F.count_if("_late")).first()
        if n_late:
            late.put(batch, told.where("_late").drop("_late"))
        on_time = told.where("not _late").drop("_late")
        counts = create_if_absent(target, on_time, order=(time_column,))
    late.move(batch, before, None if newest is None else as_utc(newest))
    return FeedReport(batch, watermark, counts.created, counts.conflicts, counts.rejected, n_late)


def follow_feed(feed: DataFrame, target: Target, late: LateRows, id_columns, time_column: str,
                lookback: timedelta, checkpoint: str, available_now: bool = True,
                on_report: Callable[[FeedReport], None] | None = None):
    """Start a query that loads a feed into a target and keeps its late rows."""
    def load(rows: DataFrame, batch: int) -> None:
        report = load_batch(target, late, with_doc_id(rows, id_columns), batch, time_column, lookback)
        if on_report is not None:
            on_report(report)
    writer = (feed.writeStream.queryName(f"docsync-feed-{target.name}")
              .option("checkpointLocation", checkpoint).foreachBatch(load))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def readmit(target: Target, late: LateRows, schema: T.StructType, order=()) -> Counts:
    """Load all late rows into the target after all, and empty the side output. Ids that came on time
    are conflicts, as ever."""
    batches = late.batches()
    if not batches:
        return Counts()
    rows = late.read(schema).where(F.col(_BATCH).isin(batches)).drop(_BATCH)
    counts = create_if_absent(target, rows, order=order)
    late.drop(batches)
    return counts
