import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from clickweave.session import local_session

    wh = tempfile.mkdtemp(prefix="clickweave-wh-")
    s = local_session("*", shuffle_partitions=8, extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="clickweave-test-")
