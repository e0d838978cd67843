import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF = "/root/testdata/sf0.01"
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vigil.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def duck():
    from oracle_check import duck as make
    return make(SF)
