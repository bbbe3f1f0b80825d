import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shopstream.session import get_spark
    s = get_spark("local[*]", app_name="shopstream-tests", extra_conf={
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.streaming.stateStore.stateSchemaCheck": "false",
    })
    yield s
    s.stop()


@pytest.fixture
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="shopstream-test-")


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns when empty)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is not None, x if x is not None else 0) for x in t))
