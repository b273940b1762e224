import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from daybook.session import local_session

    s = local_session(cores="*", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, order=None):
    """Collected rows as sorted tuples (order-insensitive bag)."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same_bag(a, b):
    """Bag equality computed by Spark (exceptAll both ways)."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
