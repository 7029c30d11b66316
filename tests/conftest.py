import pytest

from lodestone.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "tests", partitions=4)
    yield session
    session.stop()
