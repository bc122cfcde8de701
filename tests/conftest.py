import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from stratum.session import build_local

    s = build_local(cores="*", shuffle_partitions=8)
    yield s


@pytest.fixture()
def scratch(spark):
    from stratum.session import scratch_dir

    def make(label="t"):
        return scratch_dir(spark, label)
    return make
