import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import pytest

from storelake.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warehouse"))
    settings = {"spark.sql.shuffle.partitions": "4", "spark.sql.warehouse.dir": folder}
    session = local_session(8, "tests", **settings)
    yield session
    session.stop()
