import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pressloom import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "pressloom-tests", "local[8]", spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false", spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one_column(spark):
    """Values of an expression over a list of strings."""

    def run(values, expression, column="v"):
        rows = [(i, v) for i, v in enumerate(values)]
        frame = spark.createDataFrame(rows, f"i INT, {column} STRING")
        found = frame.select("i", expression.alias("out")).collect()
        return [r.out for r in sorted(found, key=lambda r: r.i)]

    return run
