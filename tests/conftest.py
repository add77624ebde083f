import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests" / "llm")]


@pytest.fixture(scope="session")
def spark():
    from voxmill.session import local_session

    session = local_session(4, **{"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"
