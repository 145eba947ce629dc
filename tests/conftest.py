import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lograft.session import build_session, checkpoint_dir

    s = build_session(master="local[8]", app_name="lograft-tests", shuffle_partitions=8,
                      conf={"spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    # tests own their checkpoint folder; a cluster names a shared one
    checkpoint_dir(s, default=tempfile.mkdtemp(prefix="lograft-ckpt-", dir="/tmp"))
    yield s
    s.stop()
