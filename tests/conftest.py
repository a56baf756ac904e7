import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Partitions are not coalesced, so that results spread over several of them as they do on a cluster.
    found = session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()
