import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from siftline.session import build_session  # noqa: E402

AS_OF = "2024-01-31 00:00:00"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "siftline-tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Rows and a DDL schema to a DataFrame in more than one partition."""

    def make(rows, schema, partitions=3):
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate one expression over a list of text inputs, in order."""

    def run(expression, inputs, kind="string"):
        df = spark.createDataFrame(
            [(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}"
        )
        rows = df.select("i", expression.alias("y")).collect()
        return [r["y"] for r in sorted(rows, key=lambda r: r["i"])]

    return run
