import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
tests_dir = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, tests_dir)

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


@pytest.fixture(scope="session")
def spark():
    from ordo.session import get_spark
    s = get_spark(master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def signal(spark):
    from ordo.sources.textio import read_signal
    return read_signal(spark, os.path.join(FIXTURES, "signal.txt")).cache()


@pytest.fixture(scope="session")
def idf(spark):
    from ordo.sources.idf import load_idf
    return load_idf(spark, os.path.join(FIXTURES, "idf.csv"), fmt="csv")
