import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mercato.session import get_spark  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = get_spark("mercato-tests", master="local[8]", **{
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": "file://" + tempfile.mkdtemp(prefix="mercato-tests-"),
    })
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    def collect(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)

    return collect


@pytest.fixture
def small():
    from workload.adapters import Marketplace

    def open_at(spark, sf="0.001"):
        return Marketplace(spark, f"{DATA}/sf{sf}")

    return open_at
