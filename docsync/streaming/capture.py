"""Changed parents as a stream, from the change feeds of parents, members and team links."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsync.operators.relational import PROJECT_CLASS


def _timed(feed: DataFrame, column: str, name: str, delay: str) -> DataFrame:
    """The feed with its event time as an instant under a name of its own, and a watermark."""
    at = F.col(column)
    if isinstance(feed.schema[column].dataType, T.TimestampNTZType):
        at = at.cast("timestamp")
    return feed.withColumn(name, at).where(F.col(name).isNotNull()).withWatermark(name, delay)


def parents_of_changed_teams(links: DataFrame, members: DataFrame, horizon: str,
                             link_time: str = "create_date", member_time: str = "mod_date",
                             delay: str = "1 second", class_id: int = PROJECT_CLASS) -> DataFrame:
    """(object_id, changed_at): the objects whose team has a member change, as both become known.

    A semi join of two streams: links (object_id, team_id, class_id, time) and member changes (team_id,
    time). Each side waits for the other; what lies more than ``horizon`` (of days or less) before the
    newest times
    of both is forgotten, which bounds the state. So a member change counts for links made up to
    ``horizon`` before or after it, and every object comes once.
    """
    left = _timed(links, link_time, "_linked_at", delay).where(F.col("class_id") == class_id).select(
        "object_id", "team_id", "_linked_at")
    right = _timed(members, member_time, "_changed_at", delay).select(
        F.col("team_id").alias("_team"), "_changed_at")
    span = F.expr(f"INTERVAL {horizon}")
    return left.join(right, (F.col("team_id") == F.col("_team"))
                     & (F.col("_changed_at") >= F.col("_linked_at") - span)
                     & (F.col("_changed_at") <= F.col("_linked_at") + span), "left_semi").select(
        "object_id", F.col("_linked_at").alias("changed_at"))


def changed_parent_ids(parents: DataFrame, parent_id: str, parent_time: str, links: DataFrame,
                       members: DataFrame, horizon: str, **options) -> DataFrame:
    """The ids of parents that changed themselves or whose team did: the streams of both. An id can
    come by both ways; whoever loads its document does so by id."""
    own = parents.where(F.col(parent_time).isNotNull()).select(F.col(parent_id))
    by_team = parents_of_changed_teams(links, members, horizon, **options)
    return own.unionByName(by_team.select(F.col("object_id").alias(parent_id)))


def follow_changes(ids: DataFrame, load: Callable[[DataFrame], None], checkpoint: str,
                   name: str = "docsync-changes", available_now: bool = True):
    """Start a query that calls ``load`` with the distinct ids of each micro-batch. A batch that is
    repeated after a failure brings the same ids again, so ``load`` should upsert."""
    def each(batch: DataFrame, _: int) -> None:
        distinct = batch.distinct()
        if not distinct.isEmpty():
            load(distinct)
    writer = (ids.writeStream.queryName(name).outputMode("append")
              .option("checkpointLocation", checkpoint).foreachBatch(each))
    return (writer.trigger(availableNow=True) if available_now else writer).start()

