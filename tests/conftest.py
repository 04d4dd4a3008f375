import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FIXTURE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from leakwatch.session import get_session

    warehouse = tempfile.mkdtemp(prefix="leakwatch-wh-")
    s = get_session(
        master="local[4]",
        shuffle_partitions=4,
        extra_conf={"spark.sql.warehouse.dir": warehouse, "spark.driver.memory": "4g"},
    )
    # Executors (python workers) import the package from the repo root.
    os.environ["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.abspath(__file__))) + os.pathsep + \
        os.environ.get("PYTHONPATH", "")
    yield s


@pytest.fixture(scope="session")
def fixture_dir():
    return FIXTURE_DIR
