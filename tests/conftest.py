import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from skygrid.session import get_session

    shared = tmp_path_factory.mktemp("shared")
    s = get_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g", spark__checkpoint__dir=f"file://{shared}", spark__sql__warehouse__dir=str(shared / "warehouse"),
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
