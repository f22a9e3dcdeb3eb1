import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerlens.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = session(
        "tests", "local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__sql__maxMetadataStringLength="10000",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)
