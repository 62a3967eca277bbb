import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from punctuality.session import get_session

    work = tempfile.mkdtemp(prefix="punctuality-test-")
    s = get_session(
        "local[4]",
        app_name="punctuality-tests",
        shuffle_partitions=4,
        extra={"spark.sql.warehouse.dir": os.path.join(work, "warehouse")},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_out(tmp_path):
    return str(tmp_path)
