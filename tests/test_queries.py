"""Every registered query: against its oracle where it has one, else that it runs with a stable schema."""

import pytest

import __spark_entry__ as entry
from sightline.plans.registry import ORACLES, QUERIES

from .conftest import SF, rows_of


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_name_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    got = df.toPandas()
    assert len(got.columns) == len(set(got.columns))
    if name in ORACLES:
        want = oracle(ORACLES[name])
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)
    else:
        assert len(got) > 0
