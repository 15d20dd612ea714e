import pytest

from wellspring.session import session


@pytest.fixture(scope="session")
def spark():
    s = session("local[4]", 2)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
