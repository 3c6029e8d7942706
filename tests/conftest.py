import pytest

from ringside.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("ringside-tests", memory="6g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()
