import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from recallspark.session import build_session
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
                            spark__driver__memory="4g", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()
