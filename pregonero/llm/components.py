"""Problem 3: pairwise links -> one group identifier per record, by Hash-to-Min.

Every vertex holds a cluster set, at first its neighbours. In a round it sends the set to the set's minimum and the
minimum to every member, until nothing changes; then the minimum of a component holds all of it and every other
vertex holds the minimum. A set is kept as rows (vertex, member), never as a list: minima are found with partial
aggregation, and the join of the rows with the one minimum per vertex is an inner join on the vertex, whose partitions
adaptive execution splits where one vertex holds a large share of the rows. So no task gathers a component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pregonero.session import cut

_PAIRS = "array<struct<v:bigint,u:bigint>>"


def _round(pairs: DataFrame) -> DataFrame:
    """One exchange: (v, u) rows -> the rows after every vertex sent its set and its minimum."""
    least = pairs.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("m"))
    both = lambda a, b: F.array(F.struct(F.col(a).alias("v"), F.col(b).alias("u")), F.struct(F.col(b).alias("v"), F.col(a).alias("u")))
    # a row (v, u) sends (m, u) and (u, m); (v, m) and (m, v) come from v being a member of its own set, once per row of v
    sent = pairs.join(least, "v").select(F.explode(F.array_union(F.when(F.col("u") != F.col("m"), both("m", "u")).otherwise(F.array().cast(_PAIRS)), F.when(F.col("v") != F.col("m"), both("m", "v")).otherwise(F.array().cast(_PAIRS)))).alias("x"))
    return sent.select("x.v", "x.u").distinct()


def _state(pairs: DataFrame) -> tuple[int, int, int]:
    """Row count and two order-free sums that tell one set of rows from another."""
    h = F.xxhash64("v", "u")
    r = pairs.agg(F.count("*"), F.coalesce(F.sum(F.shiftrightunsigned(h, 8).cast("decimal(38,0)")), F.lit(0)), F.coalesce(F.bit_xor(h), F.lit(0))).first()
    return int(r[0]), int(r[1]), int(r[2])


def hash_to_min(edges: DataFrame, a: str, b: str, max_rounds: int = 100) -> DataFrame:
    """(id, group_id) of every id that has an edge to another id; group_id is the smallest id of its component.

    Null ends and loops are no edges. Repeated and reversed edges count once. An empty input gives an empty result.
    Each round is checkpointed in the shared folder, so lost executors cost at most one round. It raises an error if
    max_rounds rounds don't suffice (their number grows as the logarithm of the longest path).
    """
    ends = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where(F.col("a") != F.col("b"))
    pairs = ends.select(F.inline(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("u")), F.struct(F.col("b").alias("v"), F.col("a").alias("u"))))).distinct()
    pairs = cut(pairs)
    state = _state(pairs)
    for _ in range(max_rounds):
        after = cut(_round(pairs))
        new = _state(after)
        pairs, same, state = after, new == state, new
        if same:
            return pairs.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("group_id")).select(F.col("v").alias("id"), "group_id")
    raise RuntimeError(f"hash_to_min isn't stable after {max_rounds} rounds")


def canonical_groups(links: DataFrame) -> DataFrame:
    """(lot_id, group_id) of the lots that match links join. Links of kind `none`, in any case and spacing, record a
    comparison without a match; a missing kind is a match."""
    kind = F.lower(F.regexp_replace(F.coalesce(F.col("match_kind"), F.lit("")), r"[^\p{L}]+", ""))
    return hash_to_min(links.where(kind != "none"), "canonical_lot_id", "secondary_lot_id").select(F.col("id").alias("lot_id"), "group_id")
