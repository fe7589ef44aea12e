import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from riskframe.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="riskframe-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def txns(spark):
    from riskframe.sources import events_transactions
    return events_transactions(spark, SF01)


@pytest.fixture(scope="session")
def features(spark, txns):
    from pyspark import StorageLevel
    from riskframe.operators.features import build_features
    return build_features(txns).persist(StorageLevel.MEMORY_AND_DISK)
