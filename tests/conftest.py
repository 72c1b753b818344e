import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from relgraph.session import local_session

    return local_session(8, shuffle_partitions=4)


@pytest.fixture
def rows(spark):
    """A frame from literal rows: rows("id bigint, a bigint", [(1, 2)])."""

    def make(schema, data):
        from relgraph.sources.tables import literal_rows

        return literal_rows(spark, schema, data)

    return make


@pytest.fixture
def settings(spark):
    changed = {}

    def change(**values):
        for key, value in values.items():
            key = "spark.sql." + key.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
