import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def many(spark):
    """Values of a column expression for several texts, in order, in one job."""
    from pyspark.sql import functions as F

    def evaluate(function, texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
        found = rows.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()
        return [r["y"] for r in found]

    return evaluate
