import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("promptmill-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Values of a column function over rows of strings, in row order."""
    from pyspark.sql import functions as F

    def run(function, *columns):
        names = [f"c{i}" for i in range(len(columns))]
        schema = "at long, " + ", ".join(f"{name} string" for name in names)
        rows = [(i, *values) for i, values in enumerate(zip(*columns))]
        result = spark.createDataFrame(rows, schema).select(
            "at", function(*[F.col(name) for name in names]).alias("out")
        )
        return [row.out for row in sorted(result.collect(), key=lambda row: row.at)]

    return run
