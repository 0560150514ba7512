"""Specs written as SQL text give what the DataFrame helpers give."""

import os

import pytest

from docsync import SyncSpec
from docsync.plans import init, sync_once
from docsync.sources import extension_rows, full, window
from workload import adapters, queries

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

COLUMNS = """p.pid, p.cust, p.prio,
  date_format(p.mod_date, "yyyy-MM-dd'T'HH:mm:ss'.000Z'") AS mod_date,
  date_format(p.create_date, "yyyy-MM-dd'T'HH:mm:ss'.000Z'") AS create_date,
  c.c_name AS description, c.c_mktsegment AS comments, m.user_ids"""
LISTS = """(SELECT o.object_id,
    listagg(CAST(t.user_id AS STRING), ',') WITHIN GROUP (ORDER BY t.user_id) AS user_ids
  FROM team_object o, team_member t{more}
  WHERE o.class_id = 1000000 AND t.team_id = o.team_id AND t.current_record = 1{also}
  GROUP BY o.object_id) m"""
JOINS = "WHERE p.pid = m.object_id AND p.cust = c.c_custkey"
CHANGES = """, (SELECT team_id FROM team_member
    WHERE nvl(mod_date, created) > ? AND nvl(mod_date, created) < ?) ch"""

INIT = (f"SELECT {COLUMNS} FROM proj p, customer c, {LISTS.format(more='', also='')} {JOINS} "
        "AND nvl(p.mod_date, p.create_date) < ?")
SYNC = (f"SELECT {COLUMNS} FROM proj p, customer c, {LISTS.format(more='', also='')} {JOINS} "
        "AND nvl(p.mod_date, p.create_date) > ? AND nvl(p.mod_date, p.create_date) < ? UNION "
        f"SELECT {COLUMNS} FROM proj p, customer c, "
        f"{LISTS.format(more=CHANGES, also=' AND ch.team_id = o.team_id')} {JOINS}")


@pytest.fixture(scope="module")
def spec(spark):
    adapters.proj(spark, SF).createOrReplaceTempView("proj")
    adapters.table(spark, SF, "customer").createOrReplaceTempView("customer")
    adapters.team_object(spark, SF).createOrReplaceTempView("team_object")
    adapters.team_member(spark, SF).selectExpr(
        "*", "CAST(null AS TIMESTAMP_NTZ) AS created").createOrReplaceTempView("team_member")
    adapters.attr(spark, SF).createOrReplaceTempView("attr")
    adapters.param(spark).createOrReplaceTempView("param")
    return SyncSpec(
        name="full", id_columns="PID", init_sql=INIT, sync_sql=SYNC, time_type="timestamp_ntz",
        extension_column="pid", ext_sql="""
          SELECT a.pid, d.param_name, coalesce(a.string_value,
                   date_format(a.date_value, 'yyyy-MM-dd'), CAST(a.number_value AS STRING)) AS v
          FROM attr a, param d WHERE a.param_id = d.param_id AND a.pid IN (?)""")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_full_load(spark, spec):
    assert rows(full(spark, spec, adapters.T2)) == rows(queries.q12_full_document(spark, SF))


def test_window_over_two_tables(spark, spec):
    got = rows(window(spark, spec, adapters.LO, adapters.T1))
    assert got == rows(queries.q14_changed_union_fanout(spark, SF))


def test_typed_attributes(spark, spec):
    everything = adapters.table(spark, SF, "orders").select("o_orderkey")
    assert rows(extension_rows(spark, spec, everything)) == rows(
        queries.q09_ext_typed_values(spark, SF))


def test_flow(spark, home, spec):
    first = init(spark, home, spec, adapters.T0).counts
    assert first.created == full(spark, spec, adapters.T0).count() and first.conflicts == 0
    second = sync_once(spark, home, spec, adapters.T1).counts
    target = home.target(spec)
    assert target.count() == first.created + second.created
    # both branches of the union may bring the same parent: one is created, one refused
    assert second.created + second.conflicts == window(
        spark, spec, adapters.LO, adapters.T1).count()
    expected = {str(r.pid) for r in full(spark, spec, adapters.T0).union(
        window(spark, spec, adapters.LO, adapters.T1)).collect()}
    assert {r.doc_id for r in target.ids().collect()} == expected
    enriched = target.read().where("custom_fields IS NOT NULL")
    with_lines = adapters.table(spark, SF, "lineitem").selectExpr("l_orderkey AS pid")
    assert enriched.count() == target.read().join(with_lines, "pid", "left_semi").count()
    assert all("line_" in r.custom_fields for r in enriched.collect())
