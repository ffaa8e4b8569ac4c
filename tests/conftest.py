import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sessionlens.session import get_spark
    s = get_spark("sessionlens-tests", master="local[4]", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ckpt-", dir="/tmp")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
