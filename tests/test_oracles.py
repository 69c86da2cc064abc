"""Every query with SQL gives the result of that SQL; every other one runs and keeps its schema."""

import pytest

from pregonero.plans import core_queries, survey

from .conftest import rows_of

QUERIES = core_queries.QUERIES | survey.QUERIES
ORACLES = core_queries.ORACLE_SQL | survey.ORACLE_SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck):
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert len(got.columns)
    if name in ORACLES:
        want = duck.execute(ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)


def test_no_crossing_joins(spark, sf_dir):
    for name in ("j9_five_matches", "j8_fuzzy_blocked_match", "j13_merged_registries"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
