import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tussock.session import checkpoint_dir, get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="tussock-wh-")
    s = get_spark("local[4]", app_name="tussock-tests", shuffle_partitions=4,
                  extra_conf={"spark.sql.warehouse.dir": warehouse})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tussock-test-")
