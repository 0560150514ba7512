"""Source against target by sums of ranges."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docsync import SyncSpec
from docsync.operators import digests
from docsync.operators import target as targets
from docsync.operators.digests import differences, differing_ranges, range_digests
from docsync.operators.ids import DOC_ID
from docsync.plans import expected, init, repair_differences, verify

T0 = datetime(2024, 1, 1)
SCHEMA = "doc_id string, a string, b string, n int, m map<string,int>"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def found(*args, **more):
    return {(r.doc_id, r.kind) for r in differences(*args, **more).collect()}


def some(n):
    return [(str(i), f"a{i}", None if i % 3 else "b", i, {"x": i, "y": 1}) for i in range(n)]


def test_equal_sets_have_no_differences(spark):
    rows = some(300)
    again = [(i, a, b, n, dict(reversed(m.items()))) for i, a, b, n, m in rows[::-1]]
    assert found(frame(spark, rows), frame(spark, again)) == set()
    assert found(frame(spark, []), frame(spark, [])) == set()
    one = range_digests(frame(spark, rows), ["a", "b", "n"], 7)
    two = range_digests(frame(spark, rows[::-1]).repartition(5), ["a", "b", "n"], 7)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect())) and one.count() == 7


@pytest.mark.parametrize("ranges", [1, 5, 4096])
def test_every_kind(spark, ranges):
    rows = some(200)
    other = [r for r in rows if r[0] != "7"]
    other = [(i, a, b, n, m) if i != "8" else (i, b, a, n, m) for i, a, b, n, m in other]  # moved
    other = [(*r[:4], {"x": 0}) if r[0] == "9" else r for r in other]
    other = [(*r[:3], None, r[4]) if r[0] == "11" else r for r in other]
    other += [("x", "a", "b", 1, None), rows[20], (None, "no id", None, None, None)]
    assert found(frame(spark, rows), frame(spark, other), ranges=ranges) == {
        ("7", "missing"), ("8", "changed"), ("9", "changed"), ("11", "changed"), ("x", "orphan"),
        ("20", "repeated")}
    assert found(frame(spark, rows), frame(spark, other), columns=["n"], ranges=ranges) == {
        ("7", "missing"), ("11", "changed"), ("x", "orphan"), ("20", "repeated")}


def test_random_edits_against_a_plain_comparison(spark):
    rng = random.Random(1)
    left = {str(i): (rng.choice("ab"), rng.choice([None, "c"]), rng.randrange(3)) for i in range(400)}
    right = {i: v if rng.random() > .05 else (rng.choice("ab"), rng.choice([None, "c"]), rng.randrange(3))
             for i, v in left.items() if rng.random() > .03}
    right |= {f"n{i}": ("a", None, 1) for i in range(9)}
    want = {(i, "missing") for i in left if i not in right} | {(i, "orphan") for i in right if i not in left}
    want |= {(i, "changed") for i in left if i in right and left[i] != right[i]}
    one, two = (frame(spark, [(i, *v, None) for i, v in d.items()]) for d in (left, right))
    assert found(one, two) == want


def test_types_must_agree(spark):
    with pytest.raises(ValueError, match="field n is int on one side"):
        found(frame(spark, some(2)), frame(spark, some(2)).withColumn("n", F.col("n").cast("long")))


def rows_exchanged(spark, df):
    """Rows that the exchanges of a plan that ran have written."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    text = [plan.finalPhysicalPlan()]
    while text:
        node = text.pop()
        children = node.children()
        text += [children.apply(i) for i in range(children.size())]
        name = node.nodeName()
        if "QueryStage" in name:
            text.append(node.plan())
        if name == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
    return total


def test_ranges_that_agree_are_not_exchanged_row_by_row(spark):
    rows = some(6000)
    left = frame(spark, rows)
    right = frame(spark, [(*r[:3], -1, r[4]) if r[0] == "77" else r for r in rows])
    columns = ["a", "b", "n"]
    sums = range_digests(left.select(DOC_ID, *columns), columns, 64)
    scans = left.rdd.getNumPartitions()
    assert rows_exchanged(spark, sums) - 6000 <= 64 * scans  # 6000: the repartition of the test itself
    assert len(differing_ranges(left, right, columns, 64)) == 1
    told = differences(left, right, columns, ranges=64)
    assert rows_exchanged(spark, told) - 12000 <= 2 * 6000 / 64 * 2
    assert [tuple(r) for r in told.collect()] == [("77", "changed")]


def put(spark, rows):
    spark.createDataFrame(rows, "id long, v string, n string, at timestamp").select(
        "id", "v", "n", F.col("at").alias("create_date"), F.lit(None).cast("timestamp").alias("mod_date")
    ).createOrReplaceTempView("verified")


def spec(**more):
    return SyncSpec(**({"name": "verified", "id_columns": "id", "order": "v",
                        "mapping": {"n": {"type": "integer"}, "create_date": {"type": "date"}},
                        "init_sql": "select * from verified where coalesce(mod_date, create_date) < ?"} | more))


def test_verify_and_repair(spark, home, plan):
    rows = [(i, "x", str(i), T0) for i in range(60)] + [(3, "w", "3", T0), (None, "x", "1", T0)]
    put(spark, rows)
    now = T0 + timedelta(days=1)
    init(spark, home, spec(), now)
    assert verify(spark, home, spec(), now).count() == 0
    # The source changes in place, without a change time: no window ever sees it.
    put(spark, [(i, "y" if i == 9 else v, n, t) for i, v, n, t in rows if i != 5] + [(70, "new", "7", T0), (71, "bad", "seven", T0)])
    assert {tuple(r) for r in verify(spark, home, spec(), now).collect()} == {
        ("9", "changed"), ("5", "orphan"), ("70", "missing")}
    report = repair_differences(spark, home, spec(), now)
    assert (report.counts.created, report.counts.updated, report.deleted) == (1, 1, 1)
    assert verify(spark, home, spec(), now).count() == 0
    stored = home.target("verified").read()
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, expected(spark, spec(), now).select(
        *stored.columns).collect()))
    assert {r.doc_id: r.v for r in stored.collect()}["3"] == "w"


def test_only_folders_that_differ_are_read_again(spark, home, monkeypatch):
    put(spark, [(i, "x", "1", T0) for i in range(200)])
    now = T0 + timedelta(days=1)
    init(spark, home, spec(), now)
    targets.delete(home.target("verified"), spark.createDataFrame([("17",)], "doc_id string"))
    read = []
    real = targets.Target.read
    monkeypatch.setattr(targets.Target, "read", lambda self, within=None: read.append(within) or real(self, within))
    assert [tuple(r) for r in verify(spark, home, spec(), now).collect()] == [("17", "missing")]
    assert read[0] is None and len(read[1]) == 1
    assert digests.RANGES % home.target("verified").buckets_there() == 0
