"""Windows by SQL text: what reaches the scan."""

import itertools
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docsync import SyncSpec
from docsync.sources import full, window
from docsync.sources.pushed import per_column
from workload.queries import LO, T1, proj_spec, q38_pushed_sql_window

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("text, values, expected, bound", [
    ("a > ? and coalesce(m, c) > ?", [1, 2],
     "a > ? and ((m is not null and m > ?) or (m is null and c > ?))", [1, 2, 2]),
    ("? >= NVL( t.m ,t . `c d` )", [1],
     "((t.m is not null and t.m <= ?) or (t.m is null and t . `c d` <= ?))", [1, 1]),
    ("'coalesce(m, c) > ?' -- coalesce(m, c) < ?\n and x < ?", [3],
     "'coalesce(m, c) > ?' -- coalesce(m, c) < ?\n and x < ?", [3]),
    ("ifnull(m,c) BETWEEN ? AND ? or z = ?", [1, 2, 3],
     "(((m is not null and m >= ?) or (m is null and c >= ?)) and "
     "((m is not null and m <= ?) or (m is null and c <= ?))) or z = ?", [1, 1, 2, 2, 3]),
    ("coalesce(m, c, d) > ? and coalesce(f(m), c) < ? and mycoalesce(m, c) < ?", [1, 2, 3],
     "coalesce(m, c, d) > ? and coalesce(f(m), c) < ? and mycoalesce(m, c) < ?", [1, 2, 3])])
def test_text(text, values, expected, bound):
    assert per_column(text, values) == (expected, bound)


def test_bound_of_the_creation_time():
    text, values = per_column("coalesce(x.mod, x.made) < ? and coalesce(a, b) < ?", [1, 2], "made")
    assert text == ("(((x.mod is not null and x.mod < ?) or (x.mod is null and x.made < ?)) and "
                    "(x.made is null or x.made < ?)) and ((a is not null and a < ?) or "
                    "(a is null and b < ?))")
    assert values == [1, 1, 1, 2, 2]
    assert per_column("coalesce(mod, made) > ?", [1], "made")[1] == [1, 1]


@pytest.mark.parametrize("shape", ["{}", "not {}", "{} is null", "({}) or id = 1"])
@pytest.mark.parametrize("op", ["<", "<=", ">", ">=", "="])
def test_the_same_rows_in_three_valued_logic(spark, shape, op):
    times = [None, 1, 2, 3]
    rows = [(i, m, c) for i, (m, c) in enumerate(itertools.product(times, times))]
    spark.createDataFrame(rows, "id int, m int, c int").createOrReplaceTempView("three")
    text = "select id from three where " + shape.format(f"coalesce(m, c) {op} ?")
    want = spark.sql(text, args=[2]).collect()
    new, values = per_column(text, [2])
    assert sorted(spark.sql(new, args=values).collect()) == sorted(want) and "coalesce" not in new


def test_many_placeholders_keep_their_order(spark):
    spark.createDataFrame([(i,) for i in range(100)], "t int").selectExpr(
        "t", "timestamp_seconds(t) as at").createOrReplaceTempView("ordered")
    parts = " union all ".join("select t from ordered where at > ? and at < ?" for _ in range(4))
    spec = SyncSpec(name="o", id_columns="t", init_sql="x", sync_sql=parts)
    found = window(spark, spec, datetime(1970, 1, 1, 0, 0, 10), datetime(1970, 1, 1, 0, 0, 13))
    assert sorted(r.t for r in found.collect()) == [11] * 4 + [12] * 4


def pushed(text):
    return [p for p in re.findall(r"PushedFilters: \[([^\]]*)", text) if p]


def test_a_stored_table_is_read_by_its_change_times(spark, tmp_path, plan):
    rows = spark.range(1000).select("id", F.timestamp_seconds(F.col("id")).alias("create_date"),
                                    F.when(F.col("id") % 2 == 0, F.timestamp_seconds(F.col("id") + 5))
                                    .alias("mod_date"))
    rows.write.parquet(str(tmp_path / "t"))
    spark.read.parquet(str(tmp_path / "t")).createOrReplaceTempView("stored")
    spec = SyncSpec(
        name="s", id_columns="id", init_sql="select * from stored where coalesce(mod_date, create_date) < ?",
        sync_sql="select * from stored where coalesce(mod_date, create_date) > ? and coalesce(mod_date, create_date) < ?")
    lo, hi = datetime(1970, 1, 1, 0, 1), datetime(1970, 1, 1, 0, 2)
    part = window(spark, spec, lo, hi)
    text = " ".join(pushed(plan(part)))
    assert "GreaterThan(mod_date" in text and "LessThan(create_date" in text
    assert sorted(r.id for r in part.collect()) == [
        i for i in range(1000) if 60 < i + (0 if i % 2 else 5) < 120]
    assert "LessThan(mod_date" in " ".join(pushed(plan(full(spark, spec, hi))))


def test_queries_push_their_windows(spark, plan):
    spec = proj_spec(spark, SF)
    assert "LessThan(o_orderdate" in " ".join(pushed(plan(window(spark, spec, LO, T1))))
    stored = " ".join(pushed(plan(q38_pushed_sql_window(spark, SF))))
    assert "GreaterThan(mod_date" in stored and "GreaterThan(create_date" in stored
