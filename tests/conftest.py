import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from wattline import get_spark
    s = get_spark(master="local[*]", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"


def hourly(start="2024-01-01 00:00:00", n=1):
    import datetime as dt
    t0 = dt.datetime.fromisoformat(start)
    return [t0 + dt.timedelta(hours=i) for i in range(n)]
