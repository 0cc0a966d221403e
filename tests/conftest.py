import pytest

from stationcast.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", "stationcast-tests", {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "3")
    yield session
    session.stop()
