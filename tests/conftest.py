import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snapstats.session import ensure_checkpoint_dir, session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    active = session("snapstats-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
        "spark.sql.warehouse.dir": str(warehouse),
    })
    active.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(active, str(tmp_path_factory.mktemp("checkpoint")))
    yield active
    active.stop()


@pytest.fixture(scope="session")
def small():
    return os.environ.get("SNAPSTATS_SF_DIR", "/root/testdata/sf0.001")
