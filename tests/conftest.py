import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from scholion.session import INPUT_PARTITIONS, build_session

    session = build_session("tests", "local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set(INPUT_PARTITIONS, "4")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()
