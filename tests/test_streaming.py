from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docsync.functions.times import utc_now
from docsync.plans import init
from docsync.streaming import distinct_feed, follow, follow_all, status_frame, write_feed
from tests.test_flows import found, make_spec, put

T0 = datetime(2024, 1, 1)
HOUR = timedelta(hours=1)


def test_ticks_equal_batch_and_resume(spark, home):
    put(spark, "tick", [(i, "x", T0 + i * HOUR) for i in range(48)])
    spec = make_spec("tick")
    init(spark, home, spec, T0 + 6 * HOUR)
    checkpoint, reports = f"{home.root}/checkpoint", []

    def run(until):
        query = follow(spark, home, spec, checkpoint, T0 + 6 * HOUR, until,
                       on_report=reports.append)
        query.awaitTermination()
        return query

    run(T0 + 12 * HOUR)
    assert found(home, "tick") == {str(i) for i in range(12)}
    run(T0 + 12 * HOUR)  # same checkpoint, nothing new
    assert len(reports) == 1
    query = run(T0 + 30 * HOUR)
    assert found(home, "tick") == {str(i) for i in range(30)}
    assert [r.counts.created for r in reports] == [6, 18]
    assert home.state.find("tick") == T0 + 30 * HOUR
    status = status_frame(spark, [query]).first()
    assert (status.query, status.active, status.error) == ("docsync-tick", False, None)


def test_one_query_per_target(spark, home):
    specs = []
    for name in ("many_a", "many_b"):
        put(spark, name, [(i, "x", T0 + i * HOUR) for i in range(4)])
        specs.append(make_spec(name))
        init(spark, home, specs[-1], T0 + HOUR)
    queries = follow_all(spark, home, specs, f"{home.root}/checkpoints", start=T0 + HOUR,
                         until=T0 + 3 * HOUR)
    for query in queries:
        query.awaitTermination()
    assert found(home, "many_a") == found(home, "many_b") == {"0", "1", "2"}
    assert {r.query for r in status_frame(spark, queries).collect()} == {
        "docsync-many_a", "docsync-many_b"}


def test_polling(spark, home):
    """Without an end the query goes on: a row that arrives later is picked up."""
    now = utc_now()
    put(spark, "poll", [(1, "x", T0)])
    spec = make_spec("poll")
    init(spark, home, spec, now - HOUR)
    assert found(home, "poll") == {"1"}
    put(spark, "poll", [(1, "x", T0), (2, "x", now - HOUR / 2)])
    query = follow(spark, home, spec, f"{home.root}/checkpoint", now - HOUR, interval="1 second")
    try:
        for _ in range(60):
            if found(home, "poll") == {"1", "2"} or not query.isActive:
                break
            query.awaitTermination(1)
        assert query.exception() is None
        assert found(home, "poll") == {"1", "2"}
    finally:
        query.stop()


def test_failed_query_is_visible(spark, home):
    put(spark, "boom", [(1, "x", T0)])
    spec = make_spec("boom")
    init(spark, home, spec, T0 + HOUR)
    bad = make_spec("boom", sync_sql=spec.sync_sql + " and raise_error('source') is null")
    put(spark, "boom", [(1, "x", T0 + 2 * HOUR)])
    query = follow(spark, home, bad, f"{home.root}/checkpoint", T0 + HOUR, T0 + 3 * HOUR)
    with pytest.raises(Exception, match="source"):
        query.awaitTermination()
    assert "source" in status_frame(spark, [query]).first().error
    assert home.state.find("boom") == T0 + HOUR


def test_feed_drops_repeats_across_restarts(spark, tmp_path):
    source, out = str(tmp_path / "feed"), str(tmp_path / "out")

    def deliver(lo, hi):
        (spark.range(lo, hi).select("id", (F.lit(T0).cast("timestamp_ntz")
                                           + F.make_dt_interval(secs=F.col("id"))).alias("ts"))
         .coalesce(1).write.mode("append").parquet(source))

    def run():
        feed = spark.readStream.schema("id long, ts timestamp_ntz").parquet(source)
        docs = distinct_feed(feed, ("id",), "ts", "5 seconds")
        write_feed(docs, out, str(tmp_path / "checkpoint"), "feed").awaitTermination()
        return sorted(int(r.doc_id) for r in spark.read.parquet(out).collect())

    deliver(0, 10)
    assert run() == list(range(10))
    deliver(6, 15)
    assert run() == list(range(15))
    deliver(0, 3)  # long past: dropped
    assert run() == list(range(15))
