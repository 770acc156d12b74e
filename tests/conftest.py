import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketry.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "basketry-tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.log.level": "ERROR"},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables are not here")
    return SF_DIR
