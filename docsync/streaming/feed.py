"""A change feed (files that keep arriving) without repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsync.operators.ids import DOC_ID, with_doc_id


def distinct_feed(feed: DataFrame, id_columns, time_column: str,
                  lookback: str = "1 second") -> DataFrame:
    """Documents of a stream, each id once.

    Repeats are recognised while the event time is within the lookback of the newest row, and
    rows later than that are dropped, which also bounds the state.  The overlap between
    deliveries must not exceed the lookback.
    """
    if isinstance(feed.schema[time_column].dataType, T.TimestampNTZType):
        feed = feed.withColumn(time_column, F.col(time_column).cast("timestamp"))
    return (with_doc_id(feed, id_columns).withWatermark(time_column, lookback)
            .dropDuplicatesWithinWatermark([DOC_ID]))


def write_feed(docs: DataFrame, path: str, checkpoint: str, name: str | None = None,
               available_now: bool = True):
    """Append the documents of a stream to parquet files."""
    writer = (docs.writeStream.outputMode("append").format("parquet").option("path", path)
              .option("checkpointLocation", checkpoint))
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
