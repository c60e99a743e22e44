from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from crimestats.session import recommended_conf

    builder = SparkSession.builder.master("local[4]").appName("crimestats-tests")
    for k, v in recommended_conf(shuffle_partitions=4).items():
        builder = builder.config(k, v)
    session = (builder.config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="crimestats-test-warehouse-"))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def make_tables(spark):
    """Inline CrimeTables: every relation empty unless given as a list of dicts."""
    from crimestats.schemas import INPUT_SCHEMAS
    from crimestats.sources.tables import CrimeTables

    def build(**rows):
        frames = {}
        for name, schema in INPUT_SCHEMAS.items():
            data = rows.get(name, [])
            tuples = [tuple(r.get(f.name) for f in schema.fields) for r in data]
            frames[name] = spark.createDataFrame(tuples, schema)
        return CrimeTables(**frames)

    return build
