import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from hourcast.session import build_session, checkpoint_dir
    s = build_session("local[4]", app_name="hourcast-tests", shuffle_partitions=4,
                      extra={"spark.default.parallelism": "4",
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="hc-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="hourcast-test-")


SF = "/root/testdata/sf0.001"
