import pytest

from tessera.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session(4, 4, "3g")
    s.sparkContext.setCheckpointDir(f"file://{tmp_path_factory.mktemp('shared')}")
    s.sparkContext.setLogLevel("ERROR")
    return s
