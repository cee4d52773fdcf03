from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from wattloom.session import local_session

    session = local_session(8, "tests", "6g")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows -> DataFrame of known size."""
    from wattloom.sources.readers import literal_table

    return lambda rows, schema: literal_table(spark, rows, schema)
