import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from crawlweave.session import get_spark

    s = get_spark("local[4]", app_name="crawlweave-tests", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="crawlweave-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from crawlweave.session import scratch_dir

    return scratch_dir(spark, "test")
