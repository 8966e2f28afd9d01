"""Every registered query beside its SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry_points  # noqa: E402
from oracle import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    verdict, rows = compare(spark, con, name, SF, QUERIES[name], SQL.get(name))
    assert verdict in ("match", "rows-only")
    assert rows >= 0
