import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lakeloom import checkpoint_dir, get_spark
    s = get_spark("lakeloom-tests", master="local[4]", shuffle_partitions=8,
                  extra_conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lakeloom-test-wh-")})
    checkpoint_dir(s, tempfile.mkdtemp(prefix="lakeloom-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="lakeloom-test-")
