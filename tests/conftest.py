import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"  # for Python workers


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from kinlink.session import build_session

    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "kinlink-tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
        spark__checkpoint__dir=f"file://{shared}/checkpoints", spark__sql__warehouse__dir=f"file://{shared}/warehouse",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
