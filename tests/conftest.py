import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tracelake.session import build_session

    session = build_session(
        "tests", "local[8]",
        **{
            "spark__sql__shuffle__partitions": "8",
            "spark__driver__memory": "8g",
            "spark__ui__enabled": "false",
            "spark__ui__showConsoleProgress": "false",
            "spark__checkpoint__dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
