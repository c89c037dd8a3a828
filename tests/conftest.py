import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from keytally.session import get_spark
    scratch = tempfile.mkdtemp(prefix="keytally-tests-")
    session = get_spark("local[4]", app_name="keytally-tests", shuffle_partitions=8,
                        **{"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
                           "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="keytally-run-")
