import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from siltstone.session import get_session

    session = get_session("tests", cores=4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def base():
    return DATA
