import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.join(ROOT, "tests")):
    if folder not in sys.path:
        sys.path.insert(0, folder)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set session values for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, str(value))

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture
def uneven(settings):
    """Broadcast nothing, and let adaptive execution treat every partition above the median as skewed."""

    def on():
        settings(
            spark__sql__autoBroadcastJoinThreshold=-1,
            spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
            spark__sql__adaptive__coalescePartitions__enabled="false",
            spark__sql__adaptive__advisoryPartitionSizeInBytes=64,
            spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes=64,
            spark__sql__adaptive__skewJoin__skewedPartitionFactor=1.0,
        )

    return on


def plan_text(df) -> str:
    """Physical plan before execution, one line per operator."""
    return df._jdf.queryExecution().executedPlan().toString()


def as_set(df, *columns):
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)
