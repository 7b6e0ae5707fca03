from __future__ import annotations

import pytest

from tillroll.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "*",
        "tillroll-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
