from __future__ import annotations

import pytest

from presslens.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    from tests.oracle import DATA

    return f"{DATA}/sf0.001"
