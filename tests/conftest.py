import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from kinfold.session import build_session

    shared = str(tmp_path_factory.mktemp("scratch"))
    session = build_session("tests", 8, **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)
