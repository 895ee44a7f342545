import pathlib
import sys
from contextlib import contextmanager

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

G7 = [(1, 2), (1, 3), (2, 3), (2, 4), (4, 5), (4, 6), (4, 7), (5, 6), (6, 7)]
G11 = [
    (1, 2), (1, 3), (1, 4), (1, 5), (2, 3), (2, 6), (3, 6), (4, 7), (4, 8), (5, 8), (6, 9), (7, 9),
    (7, 10), (8, 10), (9, 11), (10, 11),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("coterie-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def limits(spark):
    """Set size limits for a block, to force the paths meant for large data on small data."""

    @contextmanager
    def change(**values):
        for name, value in values.items():
            spark.conf.set(f"spark.coterie.{name}", str(value))
        try:
            yield
        finally:
            for name in values:
                spark.conf.unset(f"spark.coterie.{name}")

    return change


@pytest.fixture(scope="session")
def graph(spark):
    def make(edges):
        return spark.createDataFrame([(min(e), max(e)) for e in edges], "src long, dst long").repartition(3)

    return make
