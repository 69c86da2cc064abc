import random

from pyspark.sql import functions as F

from pregonero.llm.components import canonical_groups, hash_to_min


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {(x, find(x)) for x in parent}


def run(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    return {(r.id, r.group_id) for r in hash_to_min(df, "a", "b").collect()}


def test_random_graphs(spark):
    rng = random.Random(5)
    for n, m in ((30, 20), (60, 70)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(None, 1), (2, None), (3, 3)]
        assert run(spark, edges + edges[:5]) == brute(edges)


def test_path_and_hot_star(spark):
    path = [(i, i + 1) for i in range(60, 0, -1)]
    star = [(1000, 1001 + i) for i in range(300)]
    assert run(spark, path + star) == brute(path + star)


def test_no_edges(spark):
    assert run(spark, []) == set() and run(spark, [(1, 1), (None, 2)]) == set()


def test_kinds(spark):
    rows = [(1, 2, "address"), (3, 4, " NONE "), (5, 6, None), (7, 8, "None"), (9, 10, "None.")]
    df = spark.createDataFrame(rows, "canonical_lot_id long, secondary_lot_id long, match_kind string").withColumn("v", F.lit("clash"))
    assert {(r.lot_id, r.group_id) for r in canonical_groups(df).collect()} == {(1, 1), (2, 1), (5, 5), (6, 5)}
