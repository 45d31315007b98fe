import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from contentmart.session import get_session, local_conf  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    conf = local_conf("*", shuffle_partitions=8)
    conf["spark.driver.memory"] = "8g"
    s = get_session(conf, app="contentmart-tests")
    yield s
    s.stop()
