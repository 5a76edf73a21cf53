import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from stockroom.session import get_spark, shared_dir
    s = get_spark("local[4]", app="stockroom-tests", shuffle_partitions=4)
    # The shared folder comes from spark.checkpoint.dir; shared_dir() creates
    # a local one only when the environment names none.
    shared_dir(s)
    yield s
    s.stop()


def rows(df, order=None):
    """Collected rows as sorted tuples (order-insensitive comparisons)."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
