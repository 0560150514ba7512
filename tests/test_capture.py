"""Changed parents from streams of links and member changes."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docsync.operators.relational import PROJECT_CLASS
from docsync.streaming import changed_parent_ids, follow_changes, parents_of_changed_teams

T0 = datetime(2024, 1, 1)
DAY = timedelta(days=1)
LINKS = "object_id long, team_id long, class_id long, create_date timestamp"
MEMBERS = "team_id long, user_id long, mod_date timestamp"
PARENTS = "pid long, at timestamp"


def put(spark, path, k, rows, schema):
    spark.createDataFrame([(*r[:-1], None if r[-1] is None else T0 + r[-1] * DAY) for r in rows],
                          schema).coalesce(1).write.parquet(f"{path}/d={k}")


def streams(spark, tmp_path):
    return [spark.readStream.schema(s).parquet(str(tmp_path / n / "d=*"))
            for n, s in (("parents", PARENTS), ("links", LINKS), ("members", MEMBERS))]


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_each_side_waits_for_the_other_across_restarts(spark, tmp_path):
    rng = random.Random(2)
    links = [(o, o % 40, PROJECT_CLASS + (o % 7 == 0), 20 * k + rng.randrange(20))
             for k in range(3) for o in range(60 * k, 60 * k + 60)]
    members = [(rng.randrange(50), u, 20 * k + rng.randrange(20)) for k in range(3) for u in range(6)]
    parents = [(1000 + k, 20 * k) for k in range(3)] + [(3, 50), (2000, None)]
    found = []
    for k in range(3):
        def own(rows):
            return [r for r in rows if (r[-1] or 0) // 20 == k]
        put(spark, tmp_path / "parents", k, own(parents), PARENTS)
        put(spark, tmp_path / "links", k, own(links), LINKS)
        put(spark, tmp_path / "members", k, own(members), MEMBERS)
        p, link, member = streams(spark, tmp_path)
        ids = changed_parent_ids(p, "pid", "at", link, member, "30 DAYS")
        follow_changes(ids, lambda b: found.extend(r.pid for r in b.collect()),
                       str(tmp_path / "cp")).awaitTermination()
    horizon = 30
    want = {o for o, t, c, at in links if c == PROJECT_CLASS
            and any(m == t and abs(day - at) <= horizon for m, _, day in members)}
    assert set(found) - {1000, 1001, 1002, 3} <= want | {3}
    assert set(found) == want | {1000, 1001, 1002, 3}


def test_state_is_bounded_by_the_horizon(spark, tmp_path):
    """Links and member changes that are older than the horizon leave the state."""
    kept = []
    for k in range(5):
        put(spark, tmp_path / "links", k, [(100 * k + i, 100 * k + i, PROJECT_CLASS, 10 * k) for i in range(50)], LINKS)
        put(spark, tmp_path / "members", k, [(-1, i, 10 * k) for i in range(20)], MEMBERS)
        put(spark, tmp_path / "parents", k, [(1, 0)], PARENTS)
        _, link, member = streams(spark, tmp_path)
        query = (parents_of_changed_teams(link, member, "5 DAYS").writeStream.foreachBatch(lambda b, i: b.count())
                 .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
        query.awaitTermination()
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(kept[1:]) <= 2 * 70 and kept[-1] < 5 * 70


def test_times_without_a_zone(spark, tmp_path):
    ntz = [s.replace("timestamp", "timestamp_ntz") for s in (LINKS, MEMBERS)]
    put(spark, tmp_path / "links", 0, [(1, 7, PROJECT_CLASS, 3), (2, 8, PROJECT_CLASS, None)], LINKS)
    put(spark, tmp_path / "members", 0, [(7, 1, 4), (8, 1, 4)], MEMBERS)
    for name, s in zip(("links", "members"), (LINKS, MEMBERS)):
        column = "create_date" if name == "links" else "mod_date"
        spark.read.schema(s).parquet(str(tmp_path / name / "d=0")).withColumn(
            column, F.col(column).cast("timestamp_ntz")).write.parquet(str(tmp_path / "ntz" / name / "d=0"))
    link, member = (spark.readStream.schema(s).parquet(str(tmp_path / "ntz" / n / "d=*"))
                    for n, s in zip(("links", "members"), ntz))
    found = []
    follow_changes(parents_of_changed_teams(link, member, "5 DAYS").select("object_id"),
                   lambda b: found.extend(r.object_id for r in b.collect()), str(tmp_path / "cp")).awaitTermination()
    assert found == [1]
