"""Queries whose result SQL gives too, on the shared tables."""

import pytest

from pregonero.llm.queries import ORACLE_SQL, QUERIES

from ..conftest import rows_of


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(name, spark, sf_dir, duck):
    got, want = QUERIES[name](spark, sf_dir).toPandas(), duck.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)


@pytest.mark.parametrize("rows, pairs, keys", [("p2_entities", "p2_found", ("record_id", "entity_id")), ("p4_locations", "p4_found", ("address_id", "location"))])
def test_members_are_those_of_the_pairs(spark, sf_dir, rows, pairs, keys):
    member = QUERIES[rows](spark, sf_dir).toPandas()
    at = dict(zip(member[keys[0]], member[keys[1]]))
    got = {tuple(r) for r in QUERIES[pairs](spark, sf_dir).toPandas().itertuples(index=False)}
    ids = sorted(at)
    assert got == {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if at[a] == at[b]}


def test_every_address_is_located_or_has_a_reason(spark, sf_dir):
    a, b = QUERIES["p4_locations"](spark, sf_dir), QUERIES["p4_unlocated"](spark, sf_dir)
    ids = lambda df: {r.address_id for r in df.collect()}
    assert ids(a) | ids(b) == {r.id for r in spark.read.parquet(f"{sf_dir}/address.parquet").collect()} and not ids(a) & ids(b)
