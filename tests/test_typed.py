"""Custom fields that keep the types of their values."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docsync import SyncSpec
from docsync.operators.document import to_ndjson
from docsync.operators.enrich import flatten, typed_variant
from docsync.plans import init, sync_once

T0 = datetime(2024, 1, 1)


def docs(spark):
    return spark.createDataFrame([(1, "one"), (2, "two"), (None, "none")], "id long, name string")


def told(df):
    rows = df.select("id", F.explode("custom").alias("k", "v")).select(
        "id", "k", F.schema_of_variant("v").alias("kind"), F.to_json("v").alias("json"))
    return {(r.id, r.k): (r.kind, r.json) for r in rows.collect()}


def test_each_kind_keeps_its_type(spark):
    ext = spark.sql("""SELECT * FROM VALUES
        (1L, 'N', cast(1.5D as variant), 1), (1L, 'n', cast(2L as variant), 2), (1L, 'S', cast('7' as variant), 1),
        (1L, 'O', parse_json('{"b":[1,null],"a":{"x":"é"}}'), 1), (2L, 'B', cast(true as variant), 1),
        (2L, 'Z', cast(null as variant), 1), (1L, 'ID', cast(9 as variant), 1), (NULL, 'n', cast(1 as variant), 1),
        (3L, 'n', cast(1 as variant), 1) AS t(p, k, v, at)""")
    out = flatten(docs(spark), ext, "id", None, ("at",), ("id",), typed=True)
    assert told(out) == {(1, "n"): ("BIGINT", "2"), (1, "s"): ("STRING", '"7"'),
                         (1, "o"): ("OBJECT<a: OBJECT<x: STRING>, b: ARRAY<BIGINT>>", '{"a":{"x":"é"},"b":[1,null]}'),
                         (2, "b"): ("BOOLEAN", "true"), (2, "z"): (None, None)}
    assert {r.id: r.custom is None for r in out.collect()} == {1: False, 2: False, None: True}


@pytest.mark.parametrize("kind, value, json", [
    ("int", "5", "5"), ("decimal(5,2)", "1.25", "1.25"), ("string", "'x'", '"x"'),
    ("array<int>", "array(1, 2)", "[1,2]"), ("struct<a:int>", "named_struct('a', 1)", '{"a":1}'),
    ("map<string,int>", "map('q', 3)", '{"q":3}')])
def test_a_column_of_one_type(spark, kind, value, json):
    ext = spark.sql(f"SELECT 1L AS p, 'k' AS k, cast({value} as {kind}) AS v")
    assert told(flatten(docs(spark), ext, "id", typed=True))[(1, "k")][1] == json


def test_values_in_columns_by_type(spark):
    rows = spark.sql("""SELECT 'x' AS string_value, cast(null as timestamp_ntz) AS date_value, cast(null as decimal(10,2)) AS number_value
        UNION ALL SELECT null, timestamp_ntz '2024-03-01 05:00:00', null UNION ALL SELECT null, null, 2.50
        UNION ALL SELECT null, null, null""")
    out = rows.select(F.to_json(typed_variant(rows)).alias("j"))
    assert sorted(str(r.j) for r in out.collect()) == ['"2024-03-01"', '"x"', "2.5", "None"]


def test_through_a_load_a_window_and_bulk_text(spark, home):
    docs(spark).where("id is not null").withColumn("create_date", F.lit(T0).cast("timestamp")).withColumn(
        "mod_date", F.when(F.col("id") == 2, F.lit(datetime(2024, 1, 5))).cast("timestamp")).createOrReplaceTempView("typed_src")
    where = "coalesce(mod_date, create_date)"
    spec = SyncSpec(name="typed", id_columns="id", init_sql=f"select id, name from typed_src where {where} < ?",
                    sync_sql=f"select id, name from typed_src where {where} > ? and {where} < ?",
                    extension_column="id", fields_mode="flatten", ext_typed=True,
                    ext_source=lambda s: s.sql("select 1L p, 'Name' k, parse_json('{\"x\":[1]}') v union all "
                                               "select 2L, 'size', cast(3.5D as variant)"))
    init(spark, home, spec, datetime(2024, 1, 2))
    sync_once(spark, home, spec, datetime(2024, 1, 9))
    text = sorted(r.value for r in to_ndjson(home.target("typed").read(), "t").collect())
    assert [t.split("\n")[1] for t in text] == ['{"id":1,"name":{"x":[1]}}', '{"id":2,"name":"two","size":3.5}']


def test_declared_fields_are_not_typed(spark):
    with pytest.raises(ValueError, match="undeclared"):
        flatten(docs(spark), docs(spark), "id", ("k",), typed=True)
    with pytest.raises(ValueError, match="undeclared"):
        SyncSpec(name="t", id_columns="id", init_sql="x", ext_typed=True, ext_keys=("a",))
