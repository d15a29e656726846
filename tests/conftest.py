import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tesselia.session import build_session

    s = build_session(cores=8, memory="8g", partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
