from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docsync import Specs, SyncSpec, storage
from docsync.operators import reconcile as rec
from docsync.operators import target as targets
from docsync.operators.ids import DOC_ID
from docsync.operators.state import RefreshState, latest_state
from docsync.operators.target import Counts, Target
from docsync.plans import (Home, delete_once, fix, init, repair_missing, report_frame, run_all,
                           sync_once)

T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
SECOND, US = timedelta(seconds=1), timedelta(microseconds=1)
INIT = "select * from {v} where coalesce(mod_date, create_date) < ?"
SYNC = ("select * from {v} where coalesce(mod_date, create_date) > ? "
        "and coalesce(mod_date, create_date) < ?")


def put(spark, view, rows):
    """(id, name, change time) rows as a source table."""
    data = [(i, n, t.isoformat(sep=" ") if t else None) for i, n, t in rows]
    (spark.createDataFrame(data, "id long, name string, t string")
     .select("id", "name", F.col("t").cast("timestamp").alias("create_date"),
             F.lit(None).cast("timestamp").alias("mod_date")).createOrReplaceTempView(view))


def make_spec(view, **more):
    return SyncSpec(**({"name": view, "id_columns": "id", "init_sql": INIT.format(v=view),
                        "sync_sql": SYNC.format(v=view)} | more))


def docs(spark, *pairs):
    return spark.createDataFrame(list(pairs), "doc_id string, v string")


def content(target):
    return {r.doc_id: r.v for r in target.read().collect()}


def found(home, name):
    return {r.doc_id for r in home.target(name).ids().collect()}


# -- targets -------------------------------------------------------------------------------------

@pytest.fixture
def target(spark, tmp_path):
    return Target(spark, str(tmp_path / "t"), "docs")


@pytest.fixture(params=["broadcast", "shuffle"])
def way(request, monkeypatch):
    if request.param == "shuffle":
        monkeypatch.setattr(targets, "BROADCAST_BYTES", 0)


def test_create_if_absent(spark, target, way):
    first = docs(spark, ("a", "1"), ("a", "0"), ("b", "1"), (None, "x"))
    assert targets.create_if_absent(target, first, order=("v",)) == Counts(2, 1, 1)
    again = docs(spark, ("a", "2"), ("c", "1"), (None, "x"), (None, "y"))
    assert targets.create_if_absent(target, again, order=("v",)) == Counts(1, 1, 2)
    assert content(target) == {"a": "0", "b": "1", "c": "1"}
    assert targets.create_if_absent(target, again) == Counts(0, 2, 2)
    assert targets.create_if_absent(target, docs(spark, (None, "z"))) == Counts(0, 0, 1)
    assert target.count() == 3
    assert target.merge(0) and target.count() == 3 and target.merge(4) == 0


def test_small_batch_does_not_shuffle_the_target(spark, target, plan):
    targets.recreate(target, docs(spark, *[(str(i), "x") for i in range(100)]))
    small = F.broadcast(docs(spark, ("5", "x")).select(DOC_ID))
    text = plan(target.ids().join(small, DOC_ID, "left_semi"))
    assert "Exchange hashpartitioning" not in text and "ReadSchema: struct<doc_id:string>" in text


def test_one_document(target):
    assert targets.create_document(target, {"doc_id": "a", "v": "1"}) == Counts(1, 0, 0)
    assert targets.create_document(target, {"doc_id": "a", "v": "2"}) == Counts(0, 1, 0)
    assert content(target) == {"a": "1"}


@pytest.mark.parametrize("unique", [False, True])
def test_recreate_nothing(spark, target, unique):
    empty = docs(spark, ("a", "1")).where("v = 'no'")
    assert not target.exists()
    assert targets.recreate(target, empty, unique=unique) == Counts()
    assert target.exists() and target.count() == 0
    with pytest.raises(FileNotFoundError):
        Target(spark, target.path, "other").read()


def test_recreate_hot_id(spark, target):
    batch = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias(DOC_ID),
        F.lpad(F.col("id").cast("string"), 5, "0").alias("v")).repartition(5)
    assert targets.recreate(target, batch, order=("v",)) == Counts(2001, 999, 0)
    assert content(target)["hot"] == "00000"


def test_readers_keep_their_load(spark, target):
    targets.recreate(target, docs(spark, ("a", "1")))
    reader = target.read()
    targets.recreate(target, docs(spark, ("b", "1")))
    assert [r.doc_id for r in reader.collect()] == ["a"]
    for i in range(4):
        targets.recreate(target, docs(spark, ("c", str(i))))
    assert len(storage.folders(spark, target.path)) == 2 and content(target) == {"c": "3"}


def test_failed_write_changes_nothing(spark, target):
    targets.create_if_absent(target, docs(spark, ("a", "1")))
    before = content(target)

    def broken(rows, batch=None):
        return rows.withColumn("v", F.when(F.col("v") == "bad", F.raise_error(F.lit("sink"))
                                           ).otherwise(F.col("v")))

    batch = docs(spark, ("b", "1"), ("c", "bad"))
    with pytest.raises(Exception, match="sink"):
        targets.create_if_absent(target, batch, broken)
    assert content(target) == before
    with pytest.raises(Exception, match="sink"):
        targets.recreate(target, batch, broken)
    assert content(target) == before
    assert targets.create_if_absent(target, batch) == Counts(2, 0, 0)
    assert content(target) == {"a": "1", "b": "1", "c": "bad"}


def test_new_fields_join_the_schema(spark, target):
    targets.create_if_absent(target, docs(spark, ("a", "1")))
    wide = docs(spark, ("b", "2")).withColumn("w", F.lit(5))
    targets.create_if_absent(target, wide)
    assert sorted(tuple(r) for r in target.read().collect()) == [("a", "1", None), ("b", "2", 5)]
    with pytest.raises(ValueError, match="stored as"):
        targets.create_if_absent(target, docs(spark, ("c", "3")).withColumn("w", F.lit("text")))


def test_upsert_and_delete(spark, target, way):
    first = docs(spark, ("a", "1"), ("b", "1"), ("b", "3"), ("b", "2"))
    assert targets.upsert(target, first, order=("v",)) == Counts(2, 2, 0, 0)
    assert content(target) == {"a": "1", "b": "3"}
    second = docs(spark, ("b", "9"), ("c", "1"), (None, "x"))
    assert targets.upsert(target, second) == Counts(1, 0, 1, 1)
    assert content(target) == {"a": "1", "b": "9", "c": "1"}
    gone = docs(spark, ("a", ""), ("a", ""), ("zz", ""), (None, ""))
    assert targets.delete(target, gone) == 1
    assert content(target) == {"b": "9", "c": "1"}


def test_parallel_writers(spark, target):
    targets.create_if_absent(target, docs(spark, ("0", "x")))

    def load(k):
        return targets.create_if_absent(target, docs(spark, *[(str(i), "x")
                                                             for i in range(k, k + 6)])).created
    with ThreadPoolExecutor(4) as pool:
        created = list(pool.map(load, range(1, 13, 3)))
    assert sorted(content(target)) == sorted(str(i) for i in range(0, 16))
    assert sum(created) == 15 == target.count() - 1


def files(target):
    return set(target.read().inputFiles())


def test_upsert_writes_only_the_buckets_of_its_ids(spark, target, plan):
    targets.recreate(target, docs(spark, *[(str(i), "x") for i in range(200)]))
    before = files(target)
    assert targets.upsert(target, docs(spark, ("7", "new"))) == Counts(0, 0, 0, 1)
    after = files(target)
    assert len(before - after) == 1  # the one bucket of 7
    assert content(target)["7"] == "new" and target.count() == 200
    assert targets.upsert(target, docs(spark, ("new", "x"))) == Counts(1)
    assert after < files(target)  # nothing is replaced
    assert "Exchange" not in plan(target.read())


def test_a_window_reads_only_its_buckets(spark, target, plan):
    """And the target is not shuffled for it."""
    targets.recreate(target, docs(spark, *[(str(i), "x") for i in range(500)]))
    batch = docs(spark, ("5", "x"), ("7", "x"))
    within = [r[0] for r in batch.select(target.bucket()).distinct().collect()]
    text = plan(batch.join(target.ids(within).join(F.broadcast(batch.select(DOC_ID)), DOC_ID,
                                                   "left_semi"), DOC_ID, "left_anti"))
    assert "PartitionFilters: [isnotnull(docsync_bucket" in text or "docsync_bucket#" in text
    scan = text.split("FileScan parquet")[1].split("\n")[0]
    assert "docsync_bucket" in scan.split("PartitionFilters")[1] and "struct<doc_id:string>" in scan
    assert "Exchange hashpartitioning" not in text.split("FileScan parquet")[0].split("Initial")[0]
    assert targets.create_if_absent(target, batch) == Counts(0, 2)


def test_deleting_all_of_a_bucket(spark, target):
    targets.recreate(target, docs(spark, *[(str(i), "x") for i in range(40)]))
    assert targets.delete(target, docs(spark, *[(str(i), "") for i in range(39)])) == 39
    assert content(target) == {"39": "x"}
    assert targets.delete(target, docs(spark, ("39", ""))) == 1
    assert content(target) == {} and target.exists()
    assert targets.create_if_absent(target, docs(spark, ("1", "y"))) == Counts(1)
    assert content(target) == {"1": "y"}


def test_another_number_of_buckets_from_the_next_load_on(spark, target):
    rows = [(str(i), "x") for i in range(50)]
    targets.recreate(target, docs(spark, *rows))
    other = Target(spark, target.path.rpartition("/")[0], "docs", buckets=3)
    assert targets.create_if_absent(other, docs(spark, *rows, ("50", "y"))) == Counts(1, 50)
    targets.recreate(other, docs(spark, *rows))
    assert targets.upsert(target, docs(spark, ("3", "z"))) == Counts(0, 0, 0, 1)
    assert target.count() == 50 and content(other)["3"] == "z"


def test_merging_many_small_files(spark, target):
    targets.recreate(target, docs(spark, *[(f"base{i}", "x") for i in range(40)]))
    expected = {f"base{i}": "x" for i in range(40)}
    for i in range(12):
        ids = [(f"n{i}", "n")]
        targets.create_if_absent(target, docs(spark, *ids))
        expected.update(ids)
    assert max(Counter(f.rpartition("/")[0] for f in files(target)).values()) > 1
    assert target.merge(1) > 0
    assert max(Counter(f.rpartition("/")[0] for f in files(target)).values()) == 1
    assert content(target) == expected


def test_one_document_of_stored_types(spark, target):
    first = spark.createDataFrame([("a", 1, "x", None)], "doc_id string, n int, v string, d date")
    targets.create_if_absent(target, first)
    assert targets.create_document(target, {"doc_id": "b", "n": 2, "v": None}) == Counts(1)
    assert targets.create_document(target, {"doc_id": "c", "n": None, "w": 1.5, "u": None}) == Counts(1)
    assert targets.create_document(target, {"doc_id": None, "n": 2}) == Counts(0, 0, 1)
    assert sorted((r.doc_id, r.n, r.w) for r in target.read().collect()) == [
        ("a", 1, None), ("b", 2, None), ("c", None, 1.5)]


def test_nothing_staged_is_left(spark, target):
    before = storage.folders(spark, storage.work_dir(spark))
    targets.create_if_absent(target, docs(spark, ("a", "1")))
    targets.create_if_absent(target, docs(spark, ("b", "1")))
    assert storage.folders(spark, storage.work_dir(spark)) == before


# -- state ---------------------------------------------------------------------------------------

def test_state(spark, tmp_path):
    state = RefreshState(spark, str(tmp_path / "s"))
    assert state.find("a") is None and state.all().count() == 0
    state.save("a", T0)
    state.save("a", T1 + US)
    state.save("b", "2024-01-01T02:00:00+02:00")
    assert state.find("a") == T1 + US and state.find("b") == T0
    assert {r.index_name for r in state.all().collect()} == {"a", "b"}
    state.delete("a")
    state.delete("never")
    assert state.find("a") is None and [r.index_name for r in state.all().collect()] == ["b"]


def test_latest_state(spark):
    log = spark.sql("""SELECT * FROM VALUES ('a', 1, false, 1), ('a', 2, false, 3),
        ('a', 9, false, 2), ('b', 1, false, 1), ('b', null, true, 2)
        AS t(index_name, last_refresh_time, deleted, saved_at)""")
    assert [tuple(r) for r in latest_state(log).collect()] == [("a", 2)]


# -- flows ---------------------------------------------------------------------------------------

def test_seed_then_new_rows(spark, home):
    """Two parents with attributes and two without; ten more of each after the first load."""
    seed = [(1, "project 1", T0 - SECOND), (2, "project 2", T0 - SECOND)]
    put(spark, "prj", seed)
    put(spark, "est", [(1, "estimate 1", T0 - SECOND), (2, "estimate 2", T0 - SECOND)])
    spark.sql("""SELECT * FROM VALUES (1BD, 'label_11', 'value 11'), (1BD, 'label_12', 'value 12'),
        (2BD, 'label_21', 'value 21'), (2BD, 'label_22', 'value 22') AS t(p, k, v)
        """).createOrReplaceTempView("prj_attr")
    project = make_spec("prj", extension_column="id",
                        ext_sql="SELECT p, k, v FROM prj_attr WHERE p IN (?)")
    specs = Specs([project, make_spec("est")])
    reports = run_all(spark, home, specs, init, T0, parallel=2)
    assert [r.counts.created for r in reports] == [2, 2]
    read = {r.doc_id: r.custom_fields for r in home.target("prj").read().collect()}
    assert read == {"1": "label_11 value 11 label_12 value 12 ",
                    "2": "label_21 value 21 label_22 value 22 "}
    put(spark, "prj", seed + [(i, f"project {i}", T0 + SECOND) for i in range(10, 20)])
    put(spark, "est", [(i, f"estimate {i}", T0 + SECOND) for i in range(20, 30)])
    run_all(spark, home, specs, sync_once, T1)
    assert home.target("prj").count() == 12 and home.target("est").count() == 12
    frame = report_frame(spark, reports)
    assert [r.flow for r in frame.collect()] == ["init", "init"] and frame.count() == 2


@pytest.mark.parametrize("mode, expected", [
    ("flatten", {"label_11": "value 11", "label_12": "value 12"}), ("all_in_one", None)])
def test_other_modes_in_a_flow(spark, home, mode, expected):
    put(spark, "m", [(1, "project 1", T0)])
    ext = spark.createDataFrame([(1, "label_11", "value 11"), (1, "label_12", "value 12")],
                                "p int, k string, v string")
    spec = make_spec("m", fields_mode=mode, extension_column="id", ext_source=lambda s: ext)
    init(spark, home, spec, T1)
    row = home.target("m").read().first()
    if mode == "flatten":
        assert row.custom == expected
    else:
        assert row.all_fields.startswith("id 1 name project 1 create_date ")
        assert row.all_fields.endswith(" mod_date null label_11 value 11 label_12 value 12 ")


def test_window_edges(spark, home):
    """Rows at the last refresh, a second before it and at now, each a microsecond around."""
    moments = [T0 - SECOND - US, T0 - SECOND, T0 - SECOND + US, T0, T0 + US, T1 - US, T1, T1 + US]
    put(spark, "edge", [])
    spec = make_spec("edge")
    init(spark, home, spec, T0)
    put(spark, "edge", [(i, "x", m) for i, m in enumerate(moments)] + [(99, "never", None)])
    report = sync_once(spark, home, spec, T1)
    assert (report.lo, report.hi) == (T0 - SECOND, T1)
    assert found(home, "edge") == {"2", "3", "4", "5"}
    sync_once(spark, home, spec, T2)
    assert found(home, "edge") == {"2", "3", "4", "5", "6", "7"}
    assert sync_once(spark, home, spec, T2).status == "skipped"


def test_sync_needs_init(spark, home):
    put(spark, "gate", [(1, "x", T0)])
    spec = make_spec("gate")
    assert "target" in sync_once(spark, home, spec, T1).reason
    targets.recreate(home.target("gate"), docs(spark, ("a", "1")))
    assert "refresh time" in sync_once(spark, home, spec, T1).reason
    assert found(home, "gate") == {"a"}


def test_replay_changes_nothing(spark, home):
    put(spark, "replay", [(1, "x", T0 - SECOND), (2, "x", T0 + SECOND), (None, "x", T0 + SECOND)])
    spec = make_spec("replay")
    init(spark, home, spec, T0)
    assert sync_once(spark, home, spec, T1).counts == Counts(1, 0, 1)
    home.state.save("replay", T0)
    assert sync_once(spark, home, spec, T1).counts == Counts(0, 1, 1)
    assert found(home, "replay") == {"1", "2"}


def test_failed_sync_is_repeated(spark, home):
    put(spark, "fail", [(1, "x", T0 - SECOND), (2, "x", T0 + SECOND)])
    good = make_spec("fail")
    bad = make_spec("fail", sync_sql=SYNC.format(v="fail") + " and raise_error('source') is null")
    init(spark, home, good, T0)
    with pytest.raises(Exception, match="source"):
        sync_once(spark, home, bad, T1)
    assert home.state.find("fail") == T0
    assert sync_once(spark, home, good, T2).counts == Counts(1, 0, 0)


def test_failed_init_stops_sync(spark, home):
    put(spark, "stop", [(1, "x", T0 - SECOND)])
    spec = make_spec("stop")
    init(spark, home, spec, T0)
    bad = make_spec("stop", init_sql=INIT.format(v="stop") + " and raise_error('source') is null")
    with pytest.raises(Exception, match="source"):
        init(spark, home, bad, T1)
    assert found(home, "stop") == {"1"}
    assert sync_once(spark, home, spec, T2).status == "skipped"


def test_create_keeps_and_upsert_updates(spark, home):
    for op, expected in (("create", "old"), ("upsert", "new")):
        view = f"op_{op}"
        spec = make_spec(view, op=op)
        put(spark, view, [(1, "old", T0 - SECOND)])
        init(spark, home, spec, T0)
        put(spark, view, [(1, "new", T0 + SECOND)])
        sync_once(spark, home, spec, T1)
        assert [r.name for r in home.target(view).read().collect()] == [expected]


def test_fix(spark, home):
    put(spark, "fixed", [(1, "a", T0), (2, "b", T0), (3, "c", T0)])
    spec = make_spec("fixed", id_columns="id,name")
    assert fix(spark, home, spec, {"id": "1", "name": "a"}, T1).counts == Counts(1)
    fix(spark, home, spec, spark.createDataFrame([(2,), (3,)], "ID long"), T1)
    assert found(home, "fixed") == {"1-a", "2-b", "3-c"}
    assert home.state.find("fixed") is None
    with pytest.raises(ValueError, match="no row"):
        fix(spark, home, spec, {"id": "1", "name": "b"}, T1)


def test_repair_and_reconcile(spark, home):
    put(spark, "rep", [(i, "x", T0) for i in range(10)])
    spec = make_spec("rep")
    source = spark.sql("select cast(id as string) as doc_id from rep")
    targets.recreate(home.target("rep"), docs(spark, *[(str(i), "x") for i in (0, 3, 77)])
                     .select(DOC_ID))
    target = home.target("rep")
    assert rec.missing(source, target.read()).count() == 8
    assert [r.doc_id for r in rec.orphans(source, target.read()).collect()] == ["77"]
    assert tuple(rec.compare_counts(source, target.read()).first()) == (10, 3, False)
    assert repair_missing(spark, home, spec, T1).counts.created == 8
    assert rec.missing(source, target.read()).count() == 0
    assert rec.count_rows(source).first().total == 10


def test_delete_once(spark, home):
    put(spark, "del", [(1, "a", T0), (2, "b", T0)])
    assert delete_once(spark, home, make_spec("del")).status == "skipped"
    spec = make_spec("del", delete_sql="select id from del where name = 'a'")
    assert delete_once(spark, home, spec).status == "skipped"
    init(spark, home, spec, T1)
    assert delete_once(spark, home, spec).deleted == 1
    assert found(home, "del") == {"2"}


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 100), max_size=12),
       st.lists(st.integers(21, 99), min_size=1, max_size=3, unique=True))
def test_any_windows_give_the_full_load(spark, tmp_path_factory, seconds, cuts):
    """init and any cut of the rest into windows = init at the end."""
    home = Home(spark, str(tmp_path_factory.mktemp("p")))
    at = lambda s: T0 + timedelta(seconds=s)
    put(spark, "prop", [(i, "x", at(s)) for i, s in enumerate(seconds)])
    spec = make_spec("prop")
    init(spark, home, spec, at(20))
    for cut in [*sorted(cuts), 100]:
        sync_once(spark, home, spec, at(cut))
    assert found(home, "prop") == {str(i) for i, s in enumerate(seconds) if s < 100}


@pytest.mark.parametrize("unique", [False, True])
def test_sorted_target(spark, home, plan, unique):
    """The same documents, stored by id; a window reads only the ids around its own."""
    rows = [(i, "x", T0 - SECOND) for i in range(1000, 3000)] + [(None, "x", T0 - SECOND)] * 3
    put(spark, "sorted", rows)
    spec = make_spec("sorted", sorted_ids=True, unique_ids=unique)
    assert init(spark, home, spec, T0).counts == Counts(2000, 0, 3)
    put(spark, "sorted", rows + [(i, "x", T0 + SECOND) for i in range(2995, 3005)])
    assert sync_once(spark, home, spec, T1).counts == Counts(5, 5, 0)
    target = home.target(spec)
    assert target.count() == 2005
    inside = target.read().select(F.input_file_name().alias("f"), DOC_ID).collect()
    by_file = {}
    for r in inside:
        by_file.setdefault(r.f, []).append(r.doc_id)
    assert all(ids == sorted(ids) for ids in by_file.values())
    pushed = plan(target.ids().where(F.col(DOC_ID).between("2995", "3004")))
    assert "GreaterThanOrEqual(doc_id,2995)" in pushed
