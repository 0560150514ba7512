import importlib
import os

import pytest

from docsync.llm.oracle import ORACLE
from docsync.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_every_operator_is_registered():
    names = importlib.import_module("__spark_entry__").queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 11)}
    assert set(QUERIES) <= set(names) and "pipeline" in names


@pytest.mark.parametrize("name", list(ORACLE))
def test_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from check import TABLES, normal
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    frame = QUERIES[name](spark, SF)
    cursor = db.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(names)
    assert normal([tuple(r) for r in frame.collect()], frame.columns) == normal(
        cursor.fetchall(), names)


def test_stages(spark, odd_docs, no_docs, tmp_path):
    """Every stage takes awkward rows and no rows; all but the last keep the columns."""
    stages = importlib.import_module("corpus_pipeline").STAGES
    for name, stage in stages:
        for frame in (odd_docs, no_docs):
            out = stage(spark, frame, SF)
            if name != stages[-1][0]:
                assert out.columns == frame.columns
            assert out.count() <= 2 * frame.count() + 40


def test_pipeline_as_a_whole(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = importlib.import_module("corpus_pipeline").run(spark, SF)
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert {r.doc_id for r in out.collect()} <= ids
    places = out.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert max(r[1] for r in places) <= 2048


def test_batches_are_bounded_by_bytes(spark):
    """Long texts come to a Python worker in small batches, unless the session has a setting."""
    from docsync.llm import common
    texts = spark.range(0, 20000, 1, 1).selectExpr("repeat('x', 2000) as text")

    def most():
        return max(r[0] for r in texts.mapInArrow(
            lambda it: (b.from_pydict({"n": [b.nbytes]}) for b in it), "n long").collect())
    spark.conf.unset(common.BATCH)
    common.ship(spark)
    assert most() < 6_000_000
    spark.conf.set(common.BATCH, "12m")
    common.ship(spark)
    assert spark.conf.get(common.BATCH) == "12m"
    spark.conf.unset(common.BATCH)
