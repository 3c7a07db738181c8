import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from usagelens.session import build_session

    extra = {}
    from pyspark.sql import SparkSession

    if SparkSession.getActiveSession() is None:
        extra["spark.driver.memory"] = "4g"
    s = build_session("local[4]", "usagelens-tests", extra)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="usagelens-test-")
