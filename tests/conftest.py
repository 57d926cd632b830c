import os

import pytest

from check_oracles import connect
from reviewmill.session import local_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir):
    return connect(sf_dir)
