"""Every registered query against its SQL text on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from compare import compare, connect  # noqa: E402

from wattloom.registry import ORACLE, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert compare(got, con.execute(ORACLE[name]).df()) == "ok"


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.queries()) >= set(QUERIES)
    assert set(entry.oracle_sql()) >= set(ORACLE)
    assert entry.entry(spark).count() > 0
