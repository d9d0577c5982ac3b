"""Every registered query against its SQL twin; those without one must run with a stable schema."""

import harness
import pytest

from strokelab.plans import registry

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal(spark, small, name):
    assert harness.difference(QUERIES[name](spark, small), ORACLES[name], small) is None


#: Smaller forests and curves than the queries' own.
SIZES = {"m03_classifiers": {"trees": 5}, "m04_regressors": {"trees": 5}, "m08_m10_utility": {"trees": 3, "folds": 2, "sizes": (0.5, 1.0)}}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, small, name):
    df = QUERIES[name](spark, small, **SIZES.get(name, {}))
    assert df.columns and df.count() > 0


def test_entry():
    import __spark_entry__ as e

    assert "scores_by_tier" in e.queries() and set(e.oracle_sql()) <= set(e.queries())
