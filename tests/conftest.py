from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parent.parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lineitem(spark):
    return spark.read.parquet(f"{SF_DIR}/lineitem.parquet")


@pytest.fixture(scope="session")
def flights(lineitem):
    from tarmac.sources.derived import flights_of

    return flights_of(lineitem)


@pytest.fixture
def lines_of(spark):
    """A table of text lines."""
    return lambda *lines: spark.createDataFrame([(line,) for line in lines], "value STRING")


def rows(df, *columns) -> list[tuple]:
    """Rows in a fixed order, to compare answers."""
    picked = df.select(*(columns or sorted(df.columns)))
    return sorted((tuple(r) for r in picked.collect()), key=repr)
