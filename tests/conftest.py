import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.variant.allowDuplicateKeys", "true")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint"))).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def one(spark):
    """The value of a column expression over one row of named values."""

    def run(expression, **values):
        schema = ", ".join(f"{k} {'int' if isinstance(v, int) else 'double' if isinstance(v, float) else 'string'}" for k, v in values.items()) or "x int"
        row = tuple(values.values()) or (1,)
        return spark.createDataFrame([row], schema).select(expression.alias("v")).first()["v"]

    return run
