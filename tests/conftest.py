import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from playlens.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8, driver_memory="8g", app_name="playlens-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture(scope="session")
def edge_plays(spark):
    """Hand-made edge table F4 (FIXTURES.md): NULL items, flat users, NULL users."""
    rows = (
        [(1, 10)] * 2
        + [(1, 20), (2, 10), (2, None), (3, 10), (3, 20), (4, None), (None, 10)]
        + [(5, 10)] * 2
        + [(5, 20), (5, None)]
    )
    return spark.createDataFrame(rows, "user_id int, track_new_id int")
