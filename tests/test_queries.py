"""Every registered query against its SQL, on the smallest tables."""

import importlib
import os

import pytest

from check import TABLES, normal
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    frame = QUERIES[name](spark, SF)
    cursor = db.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(names)
    got = normal([tuple(r) for r in frame.collect()], frame.columns)
    assert got == normal(cursor.fetchall(), names)


def test_entry(spark):
    module = importlib.import_module("__spark_entry__")
    assert module.entry(spark).count() > 0
