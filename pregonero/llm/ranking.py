"""Ranks and running sums within keys of any size, without gathering a key in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Parts of a key, each sorted in one task: a key of 10^11 rows has some 25 million rows a part.
SHARDS = 4096


def _before(counts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Sum of `value` in the shards before, per key. A key has at most SHARDS rows here."""
    w = Window.partitionBy(*keys).orderBy("__shard").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("__before", F.coalesce(F.sum(value).over(w), F.lit(0)))


def ranked(rows: DataFrame, keys: list[str], order: str, weight: str | None = None, out: str = "rank", shards: int = SHARDS, ties: tuple[str, ...] = ()) -> DataFrame:
    """rows with their 0-based rank within `keys` in the order of the hash column `order` (a long), or with weight the
    sum of the weights before the row. Each key is cut into shards by the leading bits of the hash: counts per shard
    are summed up first, and only a shard is sorted in one task. ties: columns that order rows of one hash."""
    shard = F.shiftrightunsigned(F.col(order), 44).cast("int")  # 2^20 values in the order of the unsigned hash
    step = rows.withColumn("__shard", F.floor(shard / ((1 << 20) // shards)).cast("int"))
    one = F.col(weight) if weight else F.lit(1)
    counts = step.groupBy(*keys, "__shard").agg(F.sum(one).alias("__n"))
    offsets = _before(counts, keys, "__n").select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__shard").alias("__s"), "__before")
    same = F.col("__shard") == F.col("__s")
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"__k{i}"))
    # unsigned order: shift the sign bit away
    w = Window.partitionBy(*keys, "__shard").orderBy(F.shiftrightunsigned(F.col(order), 1), F.col(order), *[F.col(t) for t in ties]).rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(one).over(w), F.lit(0))
    got = step.withColumn("__in", within).join(offsets, same)
    return got.withColumn(out, F.col("__before") + F.col("__in")).drop("__shard", "__s", "__before", "__in", *[f"__k{i}" for i in range(len(keys))])
