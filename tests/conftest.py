import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from murmuro.runtime import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session(4, shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    return s
