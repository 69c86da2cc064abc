import random
from collections import Counter

import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pregonero.llm import mixing, packing, ranking, tokens


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=300))
def test_plan_places_every_item_once(sizes):
    counts = dict(Counter(sizes))
    plan = packing.plan(counts, 64)
    placed = Counter()
    for parts, k in plan:
        assert k > 0 and sum(parts) <= 64
        placed.update({p: c * k for p, c in Counter(parts).items()})
    assert placed == Counter(sizes)


def test_plan_finds_exact_complements():
    assert sorted(tuple(sorted(p)) for p, _ in packing.plan({40: 2, 24: 2, 10: 1, 54: 1, 30: 1, 20: 1, 14: 1}, 64)) == [(10, 54), (14, 20, 30), (24, 40)]


def test_exact_complements_behind_many_that_fail():
    # 31 frequent lengths leave a sum of two for 300, but only with the one 300 itself
    stock = packing._Stock({300: 1, 241: 2, 242: 1} | {x: 9 for x in range(197, 228)}, 1024)
    assert sorted(stock.three(300, 724) or []) == [241, 241, 242, 300]
    # the same behind an index from when the second of each pair was there
    stock = packing._Stock({600: 1, 40: 1, 45: 1, 339: 1} | {x: 9 for x in range(100, 130)} | {1: 1} | {x: 1 for x in range(294, 324)}, 1024)
    stock.n[1] = stock.n[294:324] = 0
    assert sorted(stock.three(600, 424) or []) == [40, 45, 339, 600]


def test_layout_of_a_hundred_billion_texts(spark):
    counts = {n: 10**9 + n * 7919 for n in range(1, 512, 5)} | {512: 3 * 10**9}
    rows = packing.layout(packing.plan(counts, 512))
    assert len(rows) < 20_000  # bounded by the capacity, not by the texts
    placed = Counter()
    for length, first, k, _, _ in rows:
        assert first == placed[length]
        placed[length] += k
    assert placed == Counter(counts)


def test_expanded_layout(spark):
    rows = [(3, 0, 12_345, 0, 0), (5, 2, 1, 12_345, 0), (3, 12_345, 12_345, 0, 1)]
    got = packing.expand(spark.createDataFrame(rows, "length int, first long, k long, container long, slot int")).collect()
    want = [(n, f + i, c + i, s) for n, f, k, c, s in rows for i in range(k)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert packing.expand(spark.createDataFrame([], "length int, first long, k long, container long, slot int")).count() == 0


def test_pack(spark):
    rng = random.Random(2)
    data = [(i, rng.choice([0, 1, 7, 100, 100, 100, 250, 511, 512, 513, 3000])) for i in range(600)] + [(1, 7)]
    df = spark.createDataFrame(data, "doc_id long, tokens int").selectExpr("*", "1 as size", "2 as slot", "3 as at")
    out = packing.pack(df, [(1, 512), (2, 2048)])
    for cid, cap in ((1, 512), (2, 2048)):
        rows = [r for r in out.where(F.col("capacity_id") == cid).collect()]
        fill, per = Counter(), Counter()
        for r in rows:
            fill[r.container_id] += r.tokens
            per[r.doc_id] += r.tokens
            assert r.piece_no == 0 or dict(data)[r.doc_id] > cap
        assert max(fill.values()) <= cap and sorted(fill) == list(range(len(fill)))
        want = Counter()
        for i, n in data:
            want[i] += n
        assert per == Counter({k: v for k, v in want.items() if v})
        assert sum(fill.values()) / (len(fill) * cap) > 0.97
    assert packing.pack(df.limit(0), [(1, 512)]).count() == 0


def test_ranks_match_sorting(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("k"), F.xxhash64("id").alias("h"), "id", (F.col("id") % 7).alias("w"))
    got = ranking.ranked(df, ["k"], "h", out="r").collect()
    for k in range(3):
        assert sorted(r.r for r in got if r.k == k) == list(range(sum(1 for r in got if r.k == k)))
    sums = ranking.ranked(df, ["k"], "h", weight="w", out="before").collect()
    assert max(r.before + r.w for r in sums if r.k == 0) == sum(i % 7 for i in range(2000) if i % 3 == 0)


def test_tree_sums():
    out = mixing.split_tree([1000, 3, 0, 77], 32, 5)
    assert out.shape == (32, 4) and list(out.sum(0)) == [1000, 3, 0, 77] and out.sum(1).max() - out.sum(1).min() <= 2


def test_ten_billion_blocks():
    tokens = 10**10 * 4096
    size = mixing.block_size(tokens, 4096)
    blocks = [-(-int(tokens * share) // size) for share in (0.6, 0.3, 0.1)]
    assert size > 4096 and sum(blocks) <= mixing.MOST_BLOCKS + 3 and mixing.block_size(10**6, 4096) == 4096
    out = mixing.split_tree(blocks, 32, 1)
    assert list(out.sum(0)) == blocks and (out >= 0).all()


def test_permutation_of_blocks(spark):
    for n in (1, 2, 3, 5, 17, 100, 901, 5000):
        rows = spark.range(n).select("id", F.lit("s").alias("source"), F.lit(n).cast("long").alias("n"))
        got = [r.at for r in mixing.with_permuted(rows, F.col("id"), F.col("n"), "at", 3).orderBy("id").collect()]
        assert sorted(got) == list(range(n)) and (n < 100 or sum(a == i for i, a in enumerate(got)) < 10)
    top = spark.range(1).select(F.lit("s").alias("source"), F.lit(399_999_999).cast("long").alias("n"))
    assert 0 <= mixing.with_permuted(top, F.lit(399_999_998), F.col("n"), "at", 3).first().at < 399_999_999


def test_mix(spark):
    data = [(i, s, 50 + i % 40) for i, s in enumerate(["a"] * 3000 + ["b"] * 400 + ["c"] * 300)] + [(9000, None, 10), (9001, "a", 0), (9002, "z", 5)]
    df = spark.createDataFrame(data, "doc_id long, source string, tokens int")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.2, 2), ("none", 0.0, 1)], "source string, target_share double, max_repeats int")
    out = mixing.mix(df, targets, shards=4, block_tokens=512)
    rows = out.collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(df.orderBy(F.rand(1)), targets, shards=4, block_tokens=512).collect()))
    got = {r.source: r for r in mixing.shares(out, targets).collect()}
    for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        assert abs(got[s].actual_share - share) < 0.01 and got[s].most_uses <= got[s].max_repeats
    assert len({(r.doc_id, r.use_no) for r in rows}) == len(rows) and got["none"].tokens == 0
    for shard in range(4):
        p = sorted(r.position for r in rows if r.shard == shard)
        assert p == list(range(len(p)))
    assert mixing.mix(df.limit(0), targets).count() == 0


def test_sizes(spark):
    texts = ["Olá, mundo!", "", None, "a" * 20_000, "<|endoftext|>", "é" * 10]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: r.tokens for r in tokens.with_tokens(df).collect()}
    import base64

    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(tokens.VOCABULARY, "rb"))}
    coder = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert got == {i: len(coder.encode_ordinary(t)) if t else 0 for i, t in enumerate(texts)}
