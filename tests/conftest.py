import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from panelkit.session import local_session
    s = local_session("*", shuffle_partitions=8, app="panelkit-tests",
                      extra={"spark.driver.memory": "8g"})
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SMALL
