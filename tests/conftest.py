import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from energy_series.session import session


@pytest.fixture(scope="session")
def spark():
    s = session(
        "tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.sql.streaming.metricsEnabled": "false",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def rows(spark):
    """``rows(schema, [tuple, ...])`` with text in place of timestamps."""

    def make(schema: str, data):
        empty = spark.createDataFrame([], schema)
        times = [i for i, f in enumerate(empty.schema) if "timestamp" in f.dataType.typeName()]
        fixed = [
            tuple(at(x) if i in times and isinstance(x, str) else x for i, x in enumerate(row))
            for row in data
        ]
        return spark.createDataFrame(fixed, empty.schema)

    return make


def result(df, *order):
    """Rows as tuples, timestamps as text, sorted."""
    out = [
        tuple(str(x) if isinstance(x, dt.datetime) else x for x in row) for row in df.collect()
    ]
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))
