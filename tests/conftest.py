import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", "tests", {"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def nodes(spark):
    """Rows of one `node` column out of JSON texts."""
    from pyspark.sql import functions as F

    def build(*texts):
        rows = spark.createDataFrame([(t,) for t in texts], "text string")
        return rows.select(F.parse_json("text").alias("node"))

    return build
