import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortflow.session import build_session, clear_staged, name_local_folder


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        os.environ.get("TEST_MASTER", "local[8]"),
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    name_local_folder(session)
    yield session
    clear_staged(session)
    session.stop()
