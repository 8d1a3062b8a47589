import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tarazu.session import build

    conf = {"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4", "spark.driver.memory": "3g", "spark.ui.showConsoleProgress": "false", "spark.sql.streaming.metricsEnabled": "false"}
    s = build("tests", "local[4]", **conf)
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
