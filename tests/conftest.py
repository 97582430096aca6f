import os

import pytest
from hypothesis import settings
from pyspark.sql import SparkSession

settings.register_profile("spark", deadline=None, derandomize=True)
settings.load_profile("spark")

TESTDATA = os.environ.get("HARBORLAKE_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4,4]")  # a failed task is tried again, as on a cluster
        .appName("harborlake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "8")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="session")
def testdata():
    if not os.path.isdir(TESTDATA):
        pytest.skip(f"no tables at {TESTDATA}")
    return TESTDATA


def rows(df):
    """Rows as a sorted list of tuples, nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def plan(df):
    """Physical plan before the query has run."""
    return df.select("*")._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """Physical plan after the query has run, with what adaptive execution made of it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
