"""Documents with values that do not fit their mapping."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docsync import SyncSpec
from docsync.operators import target as targets
from docsync.operators.document import apply_mapping, split_errors, to_ndjson
from docsync.operators.ids import ERRORS
from docsync.operators.target import Counts
from docsync.plans import init, report_frame, sync_once

T0 = datetime(2024, 1, 1)
SECOND = timedelta(seconds=1)
MAPPING = {"n": {"type": "integer"}, "d": {"type": "date", "format": "yyyy-MM-dd||epoch_millis"},
           "b": {"type": "boolean"}, "v": {"type": "keyword"}}


def mapped(spark, rows, schema="doc_id string, n string, d string, b string, v string", mapping=MAPPING):
    out = apply_mapping(spark.createDataFrame(rows, schema), mapping, errors=True)
    return {r.doc_id: r for r in out.collect()}


def test_every_bad_value_is_told(spark):
    out = mapped(spark, [("ok", "12", "2024-02-29", "true", "x"), ("null", None, None, None, None),
                         ("bad", "1.5e40", "2023-02-29", "perhaps", "x"), ("ms", "-7", "17000000", "0", "")])
    assert [e.field for e in out["bad"][ERRORS]] == ["n", "d", "b"]
    assert out["bad"][ERRORS][0].asDict() == {"field": "n", "value": "1.5e40", "reason": "not integer"}
    assert out["bad"][ERRORS][1].reason == "not yyyy-MM-dd||epoch_millis"
    assert (out["bad"].n, out["bad"].d, out["bad"].b, out["bad"].v) == (None, None, None, "x")
    assert all(out[i][ERRORS] == [] for i in ("ok", "null", "ms"))
    assert (out["ok"].n, out["ms"].n, out["ms"].b) == (12, -7, False)


@pytest.mark.parametrize("form, good, bad", [
    ("strict_date_time", ["2024-01-02T03:04:05.678Z", "2024-01-02T03:04:05.6+02:00"],
     ["2024-01-02", "2024-01-02T03:04:05Z", "2024-13-02T03:04:05.678Z", "2024-01-02T25:04:05.678Z", ""]),
    ("strict_date_optional_time", ["2024-01-02", "2024-01-02T03:04:05Z", "2024-01-02T03:04"],
     ["2024-1-2", "2024-02-30", "soon", "2024-01-02 03:04"]),
    ("strict_date", ["2024-01-02"], ["2024-01-02T03:04:05.678Z", "2024-00-02"]),
    ("epoch_second", ["0", "-5"], ["1.5", "x", ""]),
    ("yyyy/MM/dd", ["2024/01/02"], ["2024-01-02", "2024/02/31"])])
def test_dates_as_text(spark, form, good, bad):
    rows = [(str(i), x) for i, x in enumerate(good + bad)]
    out = mapped(spark, rows, "doc_id string, d string", {"d": {"type": "date", "format": form}})
    assert [x for i, x in rows if not out[i][ERRORS]] == good


def test_without_errors_a_bad_value_still_ends_the_run(spark):
    df = spark.createDataFrame([("a", "x")], "doc_id string, n string")
    with pytest.raises(Exception, match="field n is declared int"):
        apply_mapping(df, MAPPING).collect()


def test_split(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", "y")], "doc_id string, n string")
    good, bad = split_errors(apply_mapping(df, MAPPING, errors=True))
    assert good.columns == ["doc_id", "n"] and [tuple(r) for r in good.collect()] == [("a", 1)]
    assert sorted((r.doc_id, r.field, r.value) for r in bad.collect()) == [("b", "n", "x"), ("c", "n", "y")]
    good, bad = split_errors(df)
    assert good.count() == 3 and bad.count() == 0
    assert "_errors" not in to_ndjson(apply_mapping(df, MAPPING, errors=True), "i").first().value


def put(spark, rows):
    spark.createDataFrame(rows, "id long, n string, at timestamp").select(
        "id", "n", F.col("at").alias("create_date"), F.lit(None).cast("timestamp").alias("mod_date")
    ).createOrReplaceTempView("unfit_src")


def spec(**more):
    where = "coalesce(mod_date, create_date)"
    return SyncSpec(**({"name": "unfit_src", "id_columns": "id", "mapping": {"n": {"type": "byte"}},
                        "init_sql": f"select * from unfit_src where {where} < ?",
                        "sync_sql": f"select * from unfit_src where {where} > ? and {where} < ?"} | more))


@pytest.mark.parametrize("op", ["create", "upsert"])
def test_a_load_goes_on(spark, home, op):
    put(spark, [(1, "1", T0), (2, "300", T0), (3, "three", T0), (4, None, T0), (None, "x", T0)])
    first = init(spark, home, spec(op=op), T0 + SECOND)
    assert first.counts == Counts(2, 0, 1, 0, 2)
    target = home.target(spec())
    assert sorted((r.doc_id, r.value) for r in target.errors().collect()) == [("2", "300"), ("3", "three")]
    assert target.read().columns == ["doc_id", "id", "n", "create_date", "mod_date"]
    later = T0 + 5 * SECOND
    put(spark, [(2, "30", later), (3, "x", later), (5, "y", later), (6, "6", later)])
    counts = sync_once(spark, home, spec(op=op), later + SECOND).counts
    assert counts == Counts(2, 0, 0, 0, 2)
    assert {r.doc_id: r.n for r in target.read().collect()} == {"1": 1, "2": 30, "4": None, "6": 6}
    # What failed before and is read again counts once; a corrected document is stored.
    home.state.save("unfit_src", T0 + 2 * SECOND)
    again = sync_once(spark, home, spec(op=op), later + 2 * SECOND).counts
    assert again.errors == 2 and again.created == 0
    assert sorted((r.doc_id, r.value) for r in target.errors().collect()) == [
        ("2", "300"), ("3", "three"), ("3", "x"), ("5", "y")]
    assert report_frame(spark, [first]).first().errors == 2
    # The next full load starts anew.
    put(spark, [(1, "1", T0)])
    init(spark, home, spec(op=op), T0 + SECOND)
    assert home.target(spec()).errors().count() == 0


def test_a_failed_new_version_leaves_the_old_one(spark, home):
    put(spark, [(1, "1", T0), (2, "2", T0)])
    init(spark, home, spec(op="upsert"), T0 + SECOND)
    put(spark, [(1, "one", T0 + 3 * SECOND), (2, "3", T0 + 3 * SECOND)])
    counts = sync_once(spark, home, spec(op="upsert"), T0 + 4 * SECOND).counts
    assert counts == Counts(0, 0, 0, 1, 1)
    assert {r.doc_id: r.n for r in home.target(spec()).read().collect()} == {"1": 1, "2": 3}
    assert targets.delete(home.target(spec()), spark.createDataFrame([("2",)], "doc_id string")) == 1
    assert home.target(spec()).errors().count() == 1


def test_stop(spark, home):
    put(spark, [(1, "x", T0)])
    with pytest.raises(Exception, match="field n is declared tinyint"):
        init(spark, home, spec(unfit="stop"), T0 + SECOND)
    with pytest.raises(ValueError, match="unfit"):
        spec(unfit="ignore")


def test_custom_fields_too(spark, home):
    put(spark, [(1, "1", T0), (2, "2", T0)])
    ext = lambda s: s.createDataFrame([(1, "size", "9"), (2, "Size", "big")], "p long, k string, v string")
    one = spec(extension_column="id", fields_mode="flatten", ext_keys=("size",), ext_source=ext,
               mapping={"size": {"type": "integer"}})
    assert init(spark, home, one, T0 + SECOND).counts == Counts(1, 0, 0, 0, 1)
    assert [tuple(r) for r in home.target(one).errors().collect()] == [("2", "size", "big", "not integer")]
