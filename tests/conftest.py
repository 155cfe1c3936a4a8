import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rosterlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
                      spark__driver__memory="4g", spark__ui__showConsoleProgress="false",
                      spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def column(spark):
    """Apply a column function to texts and collect the results in order."""
    from pyspark.sql import functions as F

    def run(fn, values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]

    return run
