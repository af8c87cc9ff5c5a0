import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabscope.functions import stats  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def people(spark):
    rows = [
        ("Alice", 25.0, 50000, "Beijing", 85.0),
        ("Bob", 30.0, 60000, "Shanghai", 90.0),
        ("Charlie", None, 70000, "Beijing", 78.0),
        ("David", 40.0, 150000, "Guangzhou", None),
        ("Eve", 35.0, 80000, "Shanghai", 88.0),
    ]
    return spark.createDataFrame(
        rows, "name string, age double, salary bigint, city string, score double"
    )


def column(df, name):
    return [r[name] for r in df.select(f"`{name}`").collect()]


def keyed(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sixteen(spark, monkeypatch):
    """Groups of over 1000 rows are hot, and every shuffle has 16 partitions as they are dealt."""
    monkeypatch.setattr(stats, "SPREAD_OVER", 1000)
    settings = {"adaptive.enabled": "false", "shuffle.partitions": "16", "autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(f"spark.sql.{k}") for k in settings}
    for k, v in settings.items():
        spark.conf.set(f"spark.sql.{k}", v)
    yield
    for k, v in before.items():
        spark.conf.set(f"spark.sql.{k}", v)


def written(df, path):
    """Read back, so that the optimizer does not know the values."""
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def most_in_a_partition(df, value):
    """Of the rows with the same value, which keeps the join in the plan."""
    return df.groupBy(F.spark_partition_id(), value).count().agg(F.max("count")).first()[0]
