import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_TINY = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from viewstar import get_session
    session = get_session("local[*]", app_name="viewstar-tests",
                          conf={"spark.sql.shuffle.partitions": "8"})
    yield session
    session.stop()
