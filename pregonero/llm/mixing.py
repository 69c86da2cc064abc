"""Problem 9: mixing sources to target shares of the tokens, by a multivariate-hypergeometric splitting tree.

The largest mix in which no source runs out is the smallest of tokens times allowed repeats by share. Each source
gives its quota in whole passes over its texts and the first part of one more pass, in a random order of its texts.
The order is cut into blocks of about equal size. A binary tree splits the numbers of blocks per source among the
output shards: each half draws its blocks without replacement, so every shard has its exact numbers and the sum is
the quota. Blocks go to shards through a keyed permutation of their numbers, and each shard is shuffled by itself. Only
numbers per source and shard are on the driver. Blocks grow with the mix, so their number stays bounded.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pregonero.functions.timestamps import barrier
from pregonero.llm.ranking import ranked
from pregonero.session import cut, small

SHARDS, BLOCK_TOKENS, SEED = 32, 4096, 20_260
#: Blocks of a mix; beyond it blocks are larger than BLOCK_TOKENS. The draws of the tree take less than 10^9.
MOST_BLOCKS = 400_000_000


def split_tree(blocks: list[int], shards: int, seed: int) -> np.ndarray:
    """shards x sources: how many blocks of each source a shard gets; the columns sum to `blocks`."""
    if shards == 1:
        return np.array([blocks], dtype=np.int64)
    left = shards // 2
    total = int(sum(blocks))
    rng = np.random.default_rng([seed, shards, total])
    draw = rng.multivariate_hypergeometric(blocks, total * left // shards, method="marginals") if total else np.zeros(len(blocks), dtype=np.int64)
    return np.vstack([split_tree([int(x) for x in draw], left, seed * 2 + 1), split_tree([int(b - x) for b, x in zip(blocks, draw)], shards - left, seed * 2 + 2)])


def block_size(tokens: float, block_tokens: int, most: int = MOST_BLOCKS) -> int:
    """Tokens a block: block_tokens, or as many as make `most` blocks of all tokens."""
    return max(block_tokens, math.ceil(tokens / most))


def with_permuted(rows: DataFrame, number: Column, count: Column, out: str, seed: int) -> DataFrame:
    """Add a keyed permutation of the numbers 0 to count - 1, each source with its own key in `source`: a Feistel network on
    a rectangle of about equal sides, the smallest that holds them, walked on while it leaves the range. A walk visits the
    numbers beyond the range only once, and they are fewer than sqrt(count); past 4,000 numbers a walk of 64 steps
    has a chance under 10^-100."""

    def shuffle(x: Column) -> Column:
        high, low = F.floor(F.sqrt(count.cast("double"))).cast("long"), F.ceil(count / F.floor(F.sqrt(count.cast("double")))).cast("long")
        h = lambda v, i, side: F.pmod(F.xxhash64(v, F.lit(seed + i), "source"), side)
        a, b = F.floor(x / low).cast("long"), F.pmod(x, low)
        for i in range(0, 4, 2):
            b = F.pmod(b + h(a, i, low), low)
            a = F.pmod(a + h(b, i + 1, high), high)
        return a * low + b

    # each step in columns of its own: a step that an expression repeats would be computed again and again
    once = barrier(rows, rows.columns, {"__number": number.cast("long")})
    once = barrier(once, rows.columns, {"__once": shuffle(F.col("__number"))})
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(64)), F.col("__once"), lambda x, _: F.when(x < count, x).otherwise(shuffle(x)))
    return once.withColumn(out, F.when(F.col("__once") < count, F.col("__once")).otherwise(walk)).drop("__once")


def mix(documents: DataFrame, targets: DataFrame, shards: int = SHARDS, block_tokens: int = BLOCK_TOKENS, seed: int = SEED, id_col: str = "doc_id", size: str = "tokens") -> DataFrame:
    """(shard, position, doc_id, source, use_no, tokens). use_no counts the uses of a text from 0 up to max_repeats - 1.

    Texts without tokens, or of a source without a target, are left out. A target without texts is left out and the
    shares of the others are taken in proportion. A quota is met up to one text per source, as texts stay whole.
    """
    spark = documents.sparkSession
    rows = documents.where(F.col(size) > 0).select(F.col(id_col).alias("doc_id"), "source", F.col(size).cast("long").alias("tokens"))
    rows = cut(rows.join(small(targets.select("source").distinct()), "source").withColumn("h", F.xxhash64("doc_id", F.lit(seed))))
    have = {r.source: int(r.t) for r in rows.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    goal = {r.source: (float(r.target_share), int(r.max_repeats)) for r in targets.collect() if have.get(r.source) and r.target_share}
    names = sorted(goal)
    scale = sum(goal[s][0] for s in names)
    total = min((have[s] * goal[s][1] / (goal[s][0] / scale) for s in names), default=0.0)
    quota = {s: min(have[s] * goal[s][1], int(total * goal[s][0] / scale)) for s in names}
    block_tokens = block_size(sum(quota.values()), block_tokens)
    per_pass = {s: math.ceil(have[s] / block_tokens) for s in names}
    numbers = {s: (quota[s] // have[s]) * per_pass[s] + math.ceil((quota[s] % have[s]) / block_tokens) for s in names}
    quotas = split_tree([numbers[s] for s in names], shards, seed) if names else np.zeros((shards, 0), dtype=np.int64)
    facts = [
        (s, quota[s] // have[s], quota[s] % have[s], per_pass[s], max(1, numbers[s]), [int(x) for x in np.cumsum(quotas[:, i])]) for i, s in enumerate(names)
    ]
    known = small(spark.createDataFrame(facts, "source string, passes long, rest long, per_pass long, blocks long, ends array<long>"))
    placed = ranked(rows, ["source"], "h", weight="tokens", out="before", ties=("doc_id",)).join(known, "source")
    # a text is in the last, partial pass if the larger part of it is within the quota
    last = (F.col("before") + F.col("tokens") / 2 <= F.col("rest")).cast("int")
    uses = F.col("passes") + last
    used = placed.where(uses > 0).select("doc_id", "source", "tokens", "before", "per_pass", "blocks", "ends", F.explode(F.sequence(F.lit(0).cast("long"), uses - 1)).alias("use_no"))
    block = F.least(F.col("use_no") * F.col("per_pass") + F.floor(F.col("before") / block_tokens), F.col("blocks") - 1)
    used = with_permuted(used, block, F.col("blocks"), "at", seed + 2)
    shard = F.size(F.filter("ends", lambda e: e <= F.col("at"))).cast("int")
    dealt = used.select("doc_id", "source", "use_no", "tokens", shard.alias("shard"), F.xxhash64("doc_id", "use_no", F.lit(seed + 1)).alias("o"))
    return ranked(dealt, ["shard"], "o", out="position", ties=("doc_id", "use_no")).select("shard", F.col("position").cast("long").alias("position"), "doc_id", "source", "use_no", "tokens")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, actual_share, tokens, texts, most_uses, max_repeats); every target comes out."""
    got = mixed.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count_distinct("doc_id").alias("texts"), (F.max("use_no") + 1).alias("most_uses"))
    total = got.agg(F.sum("tokens").alias("all"))
    out = targets.join(got, "source", "left").crossJoin(F.broadcast(total))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return out.select("source", "target_share", F.round(F.coalesce(F.col("tokens") / F.col("all"), F.lit(0.0)), 6).alias("actual_share"), zero("tokens"), zero("texts"), zero("most_uses"), "max_repeats")
