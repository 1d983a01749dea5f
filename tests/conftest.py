import pytest

from quarry.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, "6g")
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"
