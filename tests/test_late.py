"""Late rows of a feed, the history of queries, and targets that do not disturb each other."""

import random
import threading
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docsync import SyncSpec, storage
from docsync.operators import target as targets
from docsync.operators.ids import with_doc_id
from docsync.operators.target import Target
from docsync.plans import flows, init, sync_once
from docsync.plans.flows import SUPERSEDED, sync_tag
from docsync.streaming import (LateRows, RunHistory, fold_history, follow_feed, load_batch,
                               read_history, readmit, run_summary, write_feed)

T0 = datetime(2024, 1, 1)
SECOND = timedelta(seconds=1)


def rows(spark, pairs, kind="timestamp"):
    df = spark.createDataFrame([(i, None if s is None else T0 + s * SECOND) for i, s in pairs],
                               "id long, at timestamp")
    return with_doc_id(df.withColumn("at", F.col("at").cast(kind)), ("id",))


def by_hand(batches, lookback):
    """(kept, repeats, late, rejected) per batch, late rows, ids kept."""
    newest, seen, out, late = None, set(), [], []
    for k, batch in enumerate(batches):
        mark = None if newest is None else newest - lookback
        kept = repeats = gone = rejected = 0
        for i, s in sorted(batch, key=lambda x: (x[1] is not None, x[1] or 0)):
            if mark is not None and s is not None and s < mark:
                late.append((i, k))
                gone += 1
            elif i is None:
                rejected += 1
            elif i in seen:
                repeats += 1
            else:
                seen.add(i)
                kept += 1
        times = [s for _, s in batch if s is not None] + ([] if newest is None else [newest])
        newest = max(times) if times else None
        out.append((kept, repeats, gone, rejected))
    return out, late, seen


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_every_row_is_kept_repeated_or_late(spark, tmp_path, kind):
    rng = random.Random(3)
    batches = [[(rng.randrange(60) if rng.random() > .05 else None,
                 rng.choice([None, *range(60 * k, 60 * k + 80), *range(0, 40)])) for _ in range(50)]
               for k in range(4)]
    batches.insert(2, [])
    target, late = Target(spark, str(tmp_path), "t"), LateRows(spark, str(tmp_path / "late"))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo" if kind == "timestamp" else "UTC")
    try:
        got = [load_batch(target, late, rows(spark, b, kind), k, "at", 10 * SECOND)
               for k, b in enumerate(batches)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    want, gone, seen = by_hand(batches, 10)
    assert [(r.kept, r.repeats, r.late, r.rejected) for r in got] == want
    assert all(r.kept + r.repeats + r.late + r.rejected == len(b) for r, b in zip(got, batches))
    schema = rows(spark, [], kind).schema
    side = late.read(schema).collect()
    assert sorted(str((r.id, r.late_in_batch)) for r in side) == sorted(map(str, gone))
    assert {r.doc_id for r in target.ids().collect()} == {str(i) for i in seen}
    counts = readmit(target, late, schema, ("at",))
    assert counts.created + counts.conflicts + counts.rejected == len(gone)
    assert {r.id for r in target.read().collect()} == seen | {i for i, _ in gone if i is not None}
    assert late.batches() == [] and readmit(target, late, schema).created == 0


def test_a_repeated_batch_decides_as_before(spark, tmp_path, monkeypatch):
    target, late = Target(spark, str(tmp_path), "t"), LateRows(spark, str(tmp_path / "late"))
    load_batch(target, late, rows(spark, [(1, 100)]), 0, "at", 10 * SECOND)
    second = [(2, 50), (3, 95), (4, 500)]
    for where in (targets, LateRows):  # it fails in the target, then before it is noted
        with monkeypatch.context() as m:
            def fail(*a, **k):
                raise RuntimeError("lost")
            m.setattr("docsync.streaming.late.create_if_absent" if where is targets else
                      "docsync.streaming.late.LateRows.move", fail)
            with pytest.raises(RuntimeError):
                load_batch(target, late, rows(spark, second), 1, "at", 10 * SECOND)
    for _ in range(2):  # a batch may also come again when all was done
        report = load_batch(target, late, rows(spark, second), 1, "at", 10 * SECOND)
        assert report.late == 1 and report.watermark == T0 + 90 * SECOND
    assert {r.id for r in target.read().collect()} == {1, 3, 4}
    assert [r.id for r in late.read(rows(spark, []).schema).collect()] == [2]
    assert load_batch(target, late, rows(spark, [(5, 480)]), 2, "at", 10 * SECOND).late == 1


def test_feed_goes_on_where_it_ended(spark, tmp_path):
    target, late = Target(spark, str(tmp_path), "t"), LateRows(spark, str(tmp_path / "late"))
    reports = []
    for k, batch in enumerate([[(1, 100), (2, 101)], [(2, 99), (3, 5), (4, 300)], [(5, 280)]]):
        rows(spark, batch).drop("doc_id").write.parquet(str(tmp_path / f"feed/d={k}"))
        feed = spark.readStream.schema("id long, at timestamp").parquet(str(tmp_path / "feed/d=*"))
        follow_feed(feed, target, late, ("id",), "at", 20 * SECOND, str(tmp_path / "cp"),
                    on_report=reports.append).awaitTermination()
    assert [(r.batch, r.kept, r.repeats, r.late) for r in reports] == [(0, 2, 0, 0), (1, 1, 1, 1), (2, 1, 0, 0)]


def test_history_outlives_its_queries(spark, tmp_path):
    history = RunHistory(spark, str(tmp_path / "h"), prefix="hist-")
    spark.streams.addListener(history)
    src = str(tmp_path / "src")
    rows(spark, [(1, 0), (2, 1)]).write.parquet(f"{src}/a=1")
    try:
        def feed():
            return spark.readStream.schema(rows(spark, []).schema).parquet(f"{src}/a=*")
        good = write_feed(feed(), str(tmp_path / "out"), str(tmp_path / "c1"), "hist-good")
        good.awaitTermination()
        bad = write_feed(feed().where("raise_error('broken feed') is null"), str(tmp_path / "out2"),
                         str(tmp_path / "c2"), "hist-bad")
        with pytest.raises(Exception, match="broken feed"):
            bad.awaitTermination()
        other = write_feed(feed(), str(tmp_path / "out3"), str(tmp_path / "c3"), "unrelated")
        other.awaitTermination()
        assert history.await_end(good) and history.await_end(bad)
    finally:
        spark.streams.removeListener(history)
    told = {r.query: r for r in run_summary(history.read()).collect()}
    assert set(told) == {"hist-good", "hist-bad"}
    assert (told["hist-good"].batches, told["hist-good"].input_rows, told["hist-good"].state) == (1, 2, "ended")
    assert told["hist-bad"].state == "failed" and "broken feed" in told["hist-bad"].error
    before = sorted(map(str, history.read().collect()))
    assert fold_history(spark, history.path) == len(before) and fold_history(spark, history.path) == 0
    assert sorted(map(str, read_history(spark, history.path).collect())) == before
    assert read_history(spark, str(tmp_path / "none")).count() == 0


def put(spark, view, pairs):
    rows(spark, pairs).drop("doc_id").select(
        "id", F.col("at").alias("create_date"), F.lit(None).cast("timestamp").alias("mod_date")
    ).createOrReplaceTempView(view)


def spec(view, **more):
    where = "coalesce(mod_date, create_date)"
    return SyncSpec(**({"name": view, "id_columns": "id",
                        "init_sql": f"select * from {view} where {where} < ?",
                        "sync_sql": f"select * from {view} where {where} > ? and {where} < ?"} | more))


def test_a_full_load_cancels_the_sync_of_its_target_only(spark, home, monkeypatch):
    for view in ("busy", "calm"):
        put(spark, view, [(1, 0)])
        init(spark, home, spec(view), T0 + SECOND)
        put(spark, view, [(1, 0), (2, 5)])
    out = {}

    def run(name, what):
        out[name] = sync_once(spark, home, what, T0 + 10 * SECOND)
    before = home.state.find("busy")
    thread = threading.Thread(target=run, args=("busy", spec("busy", changes=lambda s, lo, hi: s.range(
        0, 4000, 1, 4).selectExpr("id", "timestamp '2024-01-01 00:00:05' as create_date",
                                  "cast(null as timestamp) as mod_date",
                                  "aggregate(sequence(1, 200000), 0L, (a, b) -> a + b % (id + 2)) as y")
        .where("y >= 0").drop("y"))))
    thread.start()
    until = time.monotonic() + 30
    while not spark.sparkContext.statusTracker().getActiveJobsIds() and time.monotonic() < until:
        time.sleep(0.05)
    time.sleep(0.5)
    other = threading.Thread(target=run, args=("calm", spec("calm")))
    other.start()
    report = init(spark, home, spec("busy"), T0 + 2 * SECOND)
    thread.join(60)
    other.join(60)
    assert report.status == "done" and out["busy"].status == "cancelled" and out["busy"].reason == SUPERSEDED
    assert before == T0 + SECOND and home.state.find("busy") == T0 + 2 * SECOND
    assert {r.doc_id for r in home.target("busy").ids().collect()} == {"1"}
    assert out["calm"].status == "done" and out["calm"].counts.created == 1
    assert home.state.find("calm") == T0 + 10 * SECOND


def test_a_failure_is_no_cancellation(spark, home):
    put(spark, "plain", [(1, 0)])
    init(spark, home, spec("plain"), T0 + SECOND)
    bad = spec("plain", changes=lambda s, lo, hi: s.sql("select raise_error('source') as id"))
    with pytest.raises(Exception, match="source"):
        sync_once(spark, home, bad, T0 + 2 * SECOND)
    assert home.state.find("plain") == T0 + SECOND
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_jobs_of_a_target_have_its_pool_and_tag(spark, home, monkeypatch):
    put(spark, "pooled", [(1, 0)])
    init(spark, home, spec("pooled"), T0 + SECOND)
    seen = []
    real = flows._write

    def write(*a):
        seen.append((spark.sparkContext.getLocalProperty("spark.scheduler.pool"),
                     set(spark.sparkContext.getJobTags())))
        return real(*a)
    monkeypatch.setattr(flows, "_write", write)
    sync_once(spark, home, spec("pooled"), T0 + 2 * SECOND)
    assert seen == [("docsync-pooled", {sync_tag(home.target("pooled"))})]
    assert not list(spark.sparkContext.getJobTags()) and storage.exists(spark, home.root)
