import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from storelake.session import get_session
    ck = tempfile.mkdtemp(prefix="storelake-test-ckpt-")
    s = get_session("local[4]", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ck, "spark.driver.memory": "8g"})
    yield s
    s.stop()
