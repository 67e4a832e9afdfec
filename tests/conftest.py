import pytest

from keepwell.session import local_session, release_scratch


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "keepwell-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release_scratch(session)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
