import os
import sys

import pytest

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "3g").config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    return DATA


@pytest.fixture(scope="session")
def column(spark):
    """Applies a column function to values and returns the results in order."""
    from pyspark.sql import functions as F

    def run(f, values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]

    return run
