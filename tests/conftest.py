import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.maxMetadataStringLength", "5000")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("work")))
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def home(spark, tmp_path):
    from docsync.plans import Home
    return Home(spark, str(tmp_path / "home"))


@pytest.fixture(scope="session")
def plan():
    """The physical plan of a DataFrame as text, after it ran."""
    def text(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString()
    return text
