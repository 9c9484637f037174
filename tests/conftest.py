import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata/sf0.001"


# Made at import, as test modules build columns at their top level.
SESSION = (
    SparkSession.builder.master("local[8]").appName("webfacts-tests")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.driver.memory", "8g")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.session.timeZone", "UTC")
    .getOrCreate())
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture
def evaluate(spark):
    """Values of one expression over a list of rows."""
    def run(expression, rows, schema):
        frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"_i int, {schema}")
        return [r["_v"] for r in frame.select("_i", expression.alias("_v")).orderBy("_i").collect()]
    return run


def plan_text(df) -> str:
    return df._jdf.queryExecution().toString()
