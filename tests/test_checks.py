"""Every registered query against its DuckDB oracle on the smallest driver tables, plus the entry."""

import pytest

import __spark_entry__ as E
import harness
from filmmart.checks.registry import all_oracles, all_queries

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["critic_review_key", "movie_key", "critic_key", "date_key", "platform", "score", "quote"]


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return harness.duck(SF)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    r = harness.compare(df, con, E.oracle_sql()[name])
    assert r["ok"], r
