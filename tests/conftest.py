import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")     # for Python workers

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pennant.session import get_session
    scratch = tempfile.mkdtemp(prefix="pennant-tests-")
    s = get_session("local[4]", "pennant-tests", {"spark.sql.shuffle.partitions": "8",
                                                  "spark.checkpoint.dir": f"{scratch}/ckpt"})
    s.sparkContext.setCheckpointDir(f"{scratch}/ckpt")
    yield s
    s.stop()
