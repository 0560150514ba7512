"""What streaming queries did, as a table that outlives them."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from docsync import storage

_SCHEMA = ("query string, run_id string, event string, batch bigint, at string, input_rows bigint, "
           "dropped_rows bigint, duration_ms bigint, error string")


class RunHistory(StreamingQueryListener):
    """Writes a row for every start, micro-batch and end of the session's streaming queries.

    A row is a small file of its own, so that queries never wait for each other; ``read`` gives all
    of them, ``fold`` puts them together. Register with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, path: str, prefix: str = "docsync-"):
        self.spark, self.path, self.prefix = spark, path.rstrip("/"), prefix
        self.names: dict[str, str] = {}

    def _put(self, run_id: str, event: str, **values) -> None:
        name = self.names.get(run_id)
        if name is None or not name.startswith(self.prefix):
            return
        row = {"query": name, "run_id": run_id, "event": event, **values}
        mark = values.get("batch", event)
        storage.write_text(self.spark, f"{self.path}/new/{run_id}-{mark}.json", json.dumps(row) + "\n")

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name or ""
        self._put(str(event.runId), "started", at=event.timestamp)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._put(str(p.runId), "batch", batch=p.batchId, at=p.timestamp, input_rows=p.numInputRows,
                  dropped_rows=sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
                  duration_ms=p.batchDuration)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run_id = str(event.runId)
        error = event.exception
        self._put(run_id, "ended" if error is None else "failed", error=error and error[:4000])
        self.names.pop(run_id, None)

    def await_end(self, query, seconds: float = 60) -> bool:
        """Wait until the end of a query has been written; events come a little later than it."""
        until = time.monotonic() + seconds
        while time.monotonic() < until:
            names = storage.files(self.spark, f"{self.path}/new")
            if any(n in names for n in (f"{query.runId}-ended.json", f"{query.runId}-failed.json")):
                return True
            time.sleep(0.1)
        return False

    def read(self) -> DataFrame:
        """All rows; a failed run has its error in a row ``failed``."""
        return read_history(self.spark, self.path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    parts = []
    if storage.exists(spark, f"{path}/new"):
        parts.append(spark.read.schema(_SCHEMA).json(f"{path}/new"))
    if storage.exists(spark, f"{path}/folded"):
        parts.append(spark.read.schema(_SCHEMA).parquet(f"{path}/folded"))
    if not parts:
        return spark.createDataFrame([], _SCHEMA)
    # A row that was folded, but not yet deleted, is there twice.
    return parts[0] if len(parts) == 1 else parts[0].union(parts[1]).distinct()


def fold_history(spark: SparkSession, path: str) -> int:
    """Put the small files into Parquet; returns how many there were."""
    names = [n for n in storage.files(spark, f"{path}/new") if n.endswith(".json")]
    if names:
        rows = spark.read.schema(_SCHEMA).json([f"{path}/new/{n}" for n in names])
        rows.coalesce(1).write.mode("append").parquet(f"{path}/folded")
        for n in names:
            storage.delete(spark, f"{path}/new/{n}")
    return len(names)


def run_summary(history: DataFrame) -> DataFrame:
    """A row per run: query, run_id, batches, input_rows, dropped_rows, last_batch, state, error."""
    ending = F.max(F.when(F.col("event").isin("ended", "failed"), F.struct("event", "error"))).alias("e")
    return history.groupBy("query", "run_id").agg(
        F.count("batch").alias("batches"), F.sum("input_rows").alias("input_rows"),
        F.sum("dropped_rows").alias("dropped_rows"), F.max("batch").alias("last_batch"), ending).select(
        "query", "run_id", "batches", "input_rows", "dropped_rows", "last_batch",
        F.coalesce("e.event", F.lit("running")).alias("state"), F.col("e.error").alias("error"))
