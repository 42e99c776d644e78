import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SCRATCH = tempfile.mkdtemp(prefix="tallyframe-tests-", dir="/tmp")


@pytest.fixture(scope="session")
def spark():
    from tallyframe.session import local_session

    s = local_session("*", shuffle_partitions=8, driver_memory="4g", extra={
        "spark.sql.warehouse.dir": os.path.join(SCRATCH, "warehouse"),
        "spark.driver.extraJavaOptions": f"-Dderby.system.home={SCRATCH}",
    })
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="case-", dir=SCRATCH)
