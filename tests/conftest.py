from __future__ import annotations

import pytest

from ledgerloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "ledgerloom-tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(folder / "checkpoints"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.sql.catalogImplementation": "in-memory",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
