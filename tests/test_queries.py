"""Every registered query beside its oracle, on the smallest tables."""
import pytest

from oracle_check import compare, connect

from barloom.queries import ORACLES, QUERIES

SLOW: set[str] = set()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_matches_oracle(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES and n not in SLOW])
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry_point

    df = entry_point.entry(spark)
    assert len(df.columns) == 39
    assert df.count() > 0
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
