from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docsync import Specs, SyncSpec
from docsync.plans.folder import load_spec, load_specs
from docsync.sources import (by_keys, changed_before, changed_between, extension_rows, full, jdbc,
                             params, window)

LAST = datetime(2024, 1, 1)
NOW = datetime(2024, 1, 2)
US = timedelta(microseconds=1)
SECOND = timedelta(seconds=1)


def rows_at(spark, moments, kind="timestamp_ntz"):
    data = [(i, m.isoformat(sep=" ") if m else None) for i, m in enumerate(moments)]
    return (spark.createDataFrame(data, "id int, t string")
            .select("id", F.col("t").cast(kind).alias("mod_date"),
                    F.lit(None).cast(kind).alias("create_date")))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_window_is_open_at_both_ends(spark, kind):
    lo = LAST - SECOND
    moments = [lo - US, lo, lo + US, LAST, NOW - US, NOW, NOW + US, None]
    got = changed_between(rows_at(spark, moments, kind), lo, NOW)
    assert sorted(r.id for r in got.collect()) == [2, 3, 4]


def test_change_time_is_mod_then_create(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (1, TIMESTAMP '2024-01-01 12:00:00', TIMESTAMP '2020-01-01'),
        (2, TIMESTAMP '2020-01-01', TIMESTAMP '2024-01-01 12:00:00'),
        (3, null, TIMESTAMP '2024-01-01 12:00:00'),
        (4, null, null) AS t(id, mod_date, create_date)""")
    assert {r.id for r in changed_between(df, LAST, NOW).collect()} == {1, 3}
    assert {r.id for r in changed_before(df, NOW).collect()} == {1, 2, 3}
    same = df.where(F.coalesce("mod_date", "create_date") > F.lit(LAST.isoformat()))
    assert {r.id for r in same.collect()} == {1, 3}


def test_the_scan_evaluates_the_window(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    rows_at(spark, [LAST, NOW]).write.parquet(path)
    text = plan(changed_between(spark.read.parquet(path), LAST, NOW).select("id"))
    pushed = text.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "GreaterThan(mod_date" in pushed and "LessThan(create_date" in pushed
    assert "cast" not in pushed


@pytest.fixture
def projects(spark):
    spark.sql("""SELECT * FROM VALUES
        (1, 'p1', TIMESTAMP '2024-01-01 01:00:00', CAST(null AS TIMESTAMP)),
        (2, 'p2', TIMESTAMP '2024-01-01 02:00:00', TIMESTAMP '2024-01-03 00:00:00'),
        (3, 'p3', null, null) AS t(ID, Name, create_date, mod_date)
        """).createOrReplaceTempView("src_project")
    return SyncSpec(
        name="project", id_columns=" ID ",
        init_sql="select * from src_project where coalesce(mod_date, create_date) < ?",
        sync_sql="select * from src_project where coalesce(mod_date, create_date) > ? "
                 "and coalesce(mod_date, create_date) < ?")


def test_sql_scans(spark, projects):
    assert full(spark, projects, NOW).columns == ["id", "name", "create_date", "mod_date"]
    assert [r.id for r in full(spark, projects, NOW).collect()] == [1]
    assert [r.id for r in window(spark, projects, NOW, "2024-01-04").collect()] == [2]


def test_keys_are_cast_to_the_column_type(spark, projects):
    late = "2025-01-01"
    assert [r.name for r in by_keys(spark, projects, late, {"ID": " 2 "}).collect()] == ["p2"]
    assert by_keys(spark, projects, late, {"id": "2", "name": "p1"}).count() == 0
    assert by_keys(spark, projects, late, {"id": "2", "name": "p2"}).count() == 1
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        by_keys(spark, projects, late, {"id": "x"}).collect()
    many = spark.createDataFrame([(1,), (2,), (2,), (9,)], "ID int")
    assert sorted(r.id for r in by_keys(spark, projects, late, many).collect()) == [1, 2]


@pytest.mark.parametrize("keys", [{}, {"nope": "1"}, {"id": ""}, {"id": None}])
def test_bad_keys(spark, projects, keys):
    with pytest.raises(ValueError):
        by_keys(spark, projects, NOW, keys)


def test_placeholders():
    sql = "select '?', \"a?\", `b?` -- ?\n /* ? */ where x > ? and y = 'it''s ?' and z < ?"
    assert params.count(sql) == 2
    assert params.fill(sql, ["1", "2"]).endswith("where x > 1 and y = 'it''s ?' and z < 2")
    assert params.window_values("? ? ? ?", 1, 2) == [1, 2, 1, 2]
    for bad in ("no marks", "? ? ?"):
        with pytest.raises(ValueError):
            params.window_values(bad, 1, 2)
    with pytest.raises(ValueError):
        params.fill("?", [])


def test_extension_ids_become_a_semi_join(spark, projects):
    spark.sql("SELECT * FROM VALUES (1, 'A', 'x'), (2, 'B', 'y'), (1, 'C', 'z') AS t(pid, k, v)"
              ).createOrReplaceTempView("src_ext")
    spec = SyncSpec(name="p", id_columns="id", init_sql="x", extension_column="ID",
                    ext_sql="SELECT pid, k, v FROM src_ext WHERE pid IN (?)")
    ids = spark.createDataFrame([(1,)], "pid long")
    got = extension_rows(spark, spec, ids)
    assert sorted(r.k for r in got.collect()) == ["A", "C"]
    assert "LeftSemi" in got._jdf.queryExecution().optimizedPlan().toString()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("docsync_ids")]
    assert extension_rows(spark, projects) is None
    assert extension_rows(spark, spec).count() == spark.table("src_ext").where(
        "pid IS NOT NULL").count()


@pytest.mark.parametrize("text,expected", [
    ("SELECT a, b, c FROM e WHERE a in (?)", "SELECT a, b, c FROM e WHERE a is not null"),
    ("select x.a, b, c from e x\nwhere x.a IN ( ? ) and b <> 'in (?)' order by 1",
     "select x.a, b, c from e x\nwhere x.a is not null and b <> 'in (?)' order by 1"),
    ("select 1 -- in (?)\n from e where min(a) in(?)", "select 1 -- in (?)\n from e where min(a) is not null"),
    ("select a from e", "select a from e"), ("select a from e where a > ?", None),
    ("select a from e where a not in (?)", None)])
def test_id_list_is_taken_out_of_the_text(spark, monkeypatch, text, expected):
    """As text only: no database is used."""
    seen = []
    monkeypatch.setattr("docsync.sources.sql.jdbc_query", lambda s, options, sql, times, split:
                        seen.append(sql))
    spec = SyncSpec(name="p", id_columns="id", init_sql="x", jdbc={"url": "jdbc:x"},
                    extension_column="id", ext_sql=text)
    if expected is None:
        with pytest.raises(ValueError):
            extension_rows(spark, spec)
    else:
        extension_rows(spark, spec)
        assert seen == [expected]


def test_specs():
    spec = SyncSpec(name="a", id_columns=" Id1 , id2", init_sql="x", fields_mode=" FLATTEN ",
                    op="Create", extension_column=" Ext ")
    assert spec.id_columns == ("id1", "id2") and spec.fields_mode == "flatten"
    assert spec.extension_column == "ext" and spec.op == "create"
    specs = Specs([spec])
    assert specs.get("a") is spec and len(specs) == 1
    with pytest.raises(KeyError, match="no spec named 'b'"):
        specs.get("b")
    with pytest.raises(ValueError):
        specs.add(spec)


@pytest.mark.parametrize("bad", [
    {"id_columns": ""}, {"init_sql": None}, {"fields_mode": "other"}, {"op": "merge"},
    {"name": ""}, {"time_type": "date"}])
def test_bad_specs(bad):
    with pytest.raises(ValueError):
        SyncSpec(**({"name": "a", "id_columns": "id", "init_sql": "x"} | bad))


def test_spec_folder(tmp_path):
    sql = tmp_path / "project" / "sql"
    sql.mkdir(parents=True)
    (sql / "init.sql").write_text("select * from t where x < ?\n")
    (sql / "sql.properties").write_text("# ids\nid_columns=ID\n#extension_column=e\n")
    (tmp_path / "project" / "mapping.json").write_text(
        '{"properties": {"id": {"type": "text"}}}')
    (tmp_path / "not_a_spec").mkdir()
    spec = load_spec(tmp_path / "project", fields_mode="flatten")
    assert (spec.name, spec.id_columns, spec.sync_sql, spec.extension_column) == (
        "project", ("id",), None, None)
    assert spec.mapping == {"id": {"type": "text"}} and spec.fields_mode == "flatten"
    assert [s.name for s in load_specs(tmp_path)] == ["project"]


class Reader:
    """Records what would be read; no database is started."""

    def __init__(self):
        self.options_seen = {}

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.options_seen = options
        return self

    def load(self):
        return self.options_seen


def test_jdbc_reads():
    connection = {"url": "jdbc:h2:mem:x", "user": "u"}
    split = {"column": "id", "lower": 1, "upper": 100, "partitions": 8}
    assert jdbc.jdbc_table(Reader(), connection, "t", split) == {
        "fetchsize": "100", "url": "jdbc:h2:mem:x", "user": "u", "dbtable": "t",
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "8"}
    query = jdbc.jdbc_query(Reader(), connection, "select * from t where nvl(m, c) < ? ;", [NOW])
    assert query["query"] == "select * from t where nvl(m, c) < {ts '2024-01-02 00:00:00'}"
    cut = jdbc.jdbc_query(Reader(), connection | {"fetchsize": 5}, "select * from t", (), split)
    assert cut["dbtable"] == "(select * from t) docsync_rows" and cut["fetchsize"] == "5"
    with pytest.raises(ValueError):
        jdbc.connection_options({"user": "u"})


def test_jdbc_spec_runs_its_sql_in_the_database(monkeypatch, spark):
    seen = []
    monkeypatch.setattr("docsync.sources.sql.jdbc_query",
                        lambda s, options, sql, times, split: seen.append(
                            (options, sql, list(times), split)) or spark.range(1))
    spec = SyncSpec(name="p", id_columns="id", init_sql="select nvl(a, b) from t where c < ?",
                    jdbc={"url": "jdbc:x", "split": {"column": "id"}}, extension_column="id",
                    ext_sql="select a, b, c from e where a in (?)")
    full(spark, spec, NOW)
    assert seen == [({"url": "jdbc:x"}, spec.init_sql, [NOW], {"column": "id"})]
    extension_rows(spark, spec)
    assert seen[1][1:] == ("select a, b, c from e where a is not null", [], {"column": "id"})
