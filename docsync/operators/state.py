"""The last refresh time of every target."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsync import storage
from docsync.functions.times import as_utc

_SCHEMA = "index_name string, last_refresh_time timestamp"


class RefreshState:
    """One small file per target, replaced in one step; Spark reads the folder as a table.

    Targets do not share a file, so flows of different targets can run side by side.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/refresh_state"

    def _file(self, name: str) -> str:
        return f"{self.path}/{name}.json"

    def save(self, name: str, last_refresh_time) -> None:
        """Insert or update."""
        at = as_utc(last_refresh_time).replace(tzinfo=timezone.utc)
        row = {"index_name": name, "last_refresh_time": at.isoformat()}
        storage.write_text(self.spark, self._file(name), json.dumps(row) + "\n")

    def delete(self, name: str) -> None:
        storage.delete(self.spark, self._file(name))

    def find(self, name: str) -> datetime | None:
        if not storage.exists(self.spark, self._file(name)):
            return None
        row = json.loads(storage.read_text(self.spark, self._file(name)))
        return as_utc(row["last_refresh_time"])

    def all(self) -> DataFrame:
        if not storage.exists(self.spark, self.path):
            return self.spark.createDataFrame([], _SCHEMA)
        return (self.spark.read.schema(_SCHEMA).option("pathGlobFilter", "*.json")
                .json(self.path))


def latest_state(log: DataFrame, saved_at: str = "saved_at") -> DataFrame:
    """(index_name, last_refresh_time) of a state kept as a log of saves and deletes.

    log: index_name, last_refresh_time, deleted and the column it is ordered by.  The latest entry
    of a target counts; if that is a delete the target has no row.
    """
    entry = F.max_by(F.struct("last_refresh_time", "deleted"), saved_at).alias("_entry")
    return (log.groupBy("index_name").agg(entry).where(~F.col("_entry.deleted"))
            .select("index_name", F.col("_entry.last_refresh_time").alias("last_refresh_time")))
