import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from roadgauge.session import build  # noqa: E402
from roadgauge.streaming.attempts import STORE  # noqa: E402

SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build(
        "tests", "local[8]",
        spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__sql__streaming__stateStore__providerClass=STORE,
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return SAMPLE


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
