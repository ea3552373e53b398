import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tickframe.session import local_session
    s = local_session("*", shuffle_partitions=8, app="tickframe-tests")
    yield s


def make(spark, rows, schema):
    """DataFrame from tuples with a DDL schema string."""
    return spark.createDataFrame(rows, schema)
