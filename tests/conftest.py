import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    session = local_session(4)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()
