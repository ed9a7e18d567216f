import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Value of a column function for each text."""

    def run(function, values):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(enumerate(values)), "i int, s string")
        return [r["v"] for r in df.select("i", function(F.col("s")).alias("v")).orderBy("i").collect()]

    return run
