import os
import sys
import tempfile

import pytest
from pyspark.sql import Row, types as T

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tallyroom.session import build_session

    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def frame(spark):
    """Small frame from a DDL schema and rows."""
    def build(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return build


@pytest.fixture(scope="session")
def one(spark):
    """Value of a column expression built from literals."""
    def evaluate(column):
        return spark.range(1).select(column.alias("v")).first()["v"]

    return evaluate


def rows(frame, *columns):
    chosen = frame.select(*columns) if columns else frame
    return [tuple(r) for r in chosen.collect()]
