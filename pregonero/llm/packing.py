"""Problem 8: filling containers of fixed capacity with whole texts, by exact-complement hashing.

What is planned is the histogram of lengths, whose size is bounded by the capacity and not by the number of texts.
From the longest length on, the gap it leaves is looked up among the single lengths, the sums of two and the sums of
three that are still available, the most available first and all of them if need be; a combination found is used as
often as its scarcest member lasts. What no exact combination takes is placed by best fit. The plan comes out as runs of containers of one pattern; texts get their
slots by an equi-join on (length, rank), so no text ever passes through the driver.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pregonero.llm.ranking import ranked
from pregonero.session import cut, small

RUN = 5_000  # containers per row of the plan before its slots are written out


class _Stock:
    """Available counts by length, with an index of the sums of two."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.n = np.zeros(capacity + 1, dtype=np.int64)
        for length, k in counts.items():
            self.n[length] = k
        self.capacity = capacity
        self.index()

    def index(self) -> None:
        has = (self.n > 0).astype(np.float64)
        size = 1 << (2 * self.capacity + 1).bit_length()
        sums = np.fft.irfft(np.fft.rfft(has, size) ** 2, size)[: self.capacity + 1]
        self.pair = sums > 0.5  # a superset once lengths run out; every use is verified

    def lasts(self, parts: list[int]) -> int:
        return min(int(self.n[length]) // k for length, k in Counter(parts).items())

    def single(self, base: int, gap: int) -> list[int] | None:
        return [base, gap] if gap > 0 and self.lasts([base, gap]) else None

    def two(self, base: list[int], gap: int) -> list[int] | None:
        if gap < 2 or not self.pair[gap]:
            return None
        a = np.arange(1, gap // 2 + 1)
        k = np.minimum(self.n[a], self.n[gap - a])
        if not k.any():
            return None
        for i in np.argsort(-k, kind="stable"):
            if k[i] == 0:
                break
            if self.lasts(base + [int(a[i]), int(gap - a[i])]):
                return base + [int(a[i]), int(gap - a[i])]
        return None

    def three(self, base: int, gap: int) -> list[int] | None:
        if gap < 3:
            return None
        firsts = self.firsts(gap)
        found = next(filter(None, (self.two([base, int(x)], gap - int(x)) for x in firsts[:24])), None)
        if found or len(firsts) <= 24:
            return found
        self.index()  # many that fail: the index is old
        return next(filter(None, (self.two([base, int(x)], gap - int(x)) for x in self.firsts(gap))), None)

    def firsts(self, gap: int) -> np.ndarray:
        """Lengths that leave a sum of two of the gap, the most available first."""
        a = np.flatnonzero((self.n[1 : gap - 1] > 0) & self.pair[gap - 1 : 1 : -1]) + 1
        return a[np.argsort(-self.n[a], kind="stable")]

    def take(self, parts: list[int], k: int) -> None:
        for length in parts:
            self.n[length] -= k


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(lengths of a container, number of such containers). Lengths must be 1..capacity; every item is placed once."""
    stock, out = _Stock(counts, capacity), []
    if stock.n[capacity]:
        out.append(([capacity], int(stock.n[capacity])))
        stock.n[capacity] = 0
    left: dict[int, int] = {}
    for length in sorted((x for x in counts if x < capacity), reverse=True):
        while stock.n[length] > 0:
            gap = capacity - length
            found = stock.single(length, gap) or stock.two([length], gap) or stock.three(length, gap)
            if not found:
                stock.index()
                break
            k = stock.lasts(found)
            stock.take(found, k)
            out.append((found, k))
        if stock.n[length] > 0:
            left[length] = int(stock.n[length])
            stock.n[length] = 0
    return out + _best_fit(left, capacity)


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Best fit by decreasing length, over groups of equal containers."""
    groups: dict[int, list[tuple[list[int], int]]] = {}
    open_gaps = np.zeros(capacity + 1, dtype=bool)
    for length in sorted(left, reverse=True):
        todo = left[length]
        while todo:
            fits = np.flatnonzero(open_gaps[length:])
            if not len(fits):
                per = capacity // length
                whole, rest = divmod(todo, per)
                if whole:
                    groups.setdefault(capacity - per * length, []).append(([length] * per, whole))
                    open_gaps[capacity - per * length] = True
                if rest:
                    groups.setdefault(capacity - rest * length, []).append(([length] * rest, 1))
                    open_gaps[capacity - rest * length] = True
                break
            gap = int(fits[0]) + length
            parts, k = groups[gap].pop()
            use = min(k, todo)
            if use < k:
                groups[gap].append((parts, k - use))
            open_gaps[gap] = bool(groups[gap])
            groups.setdefault(gap - length, []).append((parts + [length], use))
            open_gaps[gap - length] = True
            todo -= use
    return [g for gap in sorted(groups) for g in groups[gap]]


def layout(planned: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first, k, container, slot): texts first to first + k - 1 of a length, in the order of their ranks, fill the
    slot of containers container to container + k - 1. One row per pattern and slot, so as many as the plan has patterns
    and slots, which the capacity bounds, however many texts there are."""
    rows, used, base = [], Counter(), 0
    for parts, k in planned:
        for slot, length in enumerate(parts):
            rows.append((length, used[length], k, base, slot))
            used[length] += k
        base += k
    return rows


def expand(rows: DataFrame) -> DataFrame:
    """(length, at, container_id, slot) of every single slot of a layout, in two steps: runs, which are spread over the
    tasks, then their slots. A run has RUN slots or, for more than RUN^2, the root of their number, so no array is long."""
    runs = rows.withColumn("n", F.greatest(F.lit(RUN), F.ceil(F.sqrt(F.col("k").cast("double")))).cast("long"))
    runs = runs.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("k") - 1) / F.col("n")).cast("long"))).alias("run"))
    runs = runs.select("length", "first", "container", "slot", (F.col("run") * F.col("n")).alias("from"), F.least(F.col("k"), (F.col("run") + 1) * F.col("n")).alias("to"))
    each = runs.repartition("length", "from", "slot", "container").select("*", F.explode(F.sequence(F.col("from"), F.col("to") - 1)).alias("i"))
    return each.select("length", (F.col("first") + F.col("i")).alias("at"), (F.col("container") + F.col("i")).alias("container_id"), "slot")


def pack(documents: DataFrame, capacities: list[tuple[int, int]], id_col: str = "doc_id", size: str = "tokens") -> DataFrame:
    """(capacity_id, container_id, slot, doc_id, piece_no, token_from, tokens) for every text of at least one token.

    A text longer than a capacity is cut into pieces of the whole capacity and one rest; all others stay whole.
    Texts without tokens need no room and are left out. A text repeated under one id is packed as often as it occurs.
    """
    spark = documents.sparkSession
    docs = cut(documents.where(F.col(size) > 0).select(F.col(id_col).alias("doc_id"), F.col(size).alias("size")).withColumn("h", F.xxhash64("doc_id", F.lit(8))))
    out = None
    for cid, cap in sorted(capacities):
        pieces = docs.select("doc_id", "h", "size", F.posexplode(F.transform(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / cap).cast("int")), lambda i: F.least(F.lit(cap), F.col("size") - i * cap))).alias("piece_no", "tokens"))
        counts = {int(r.tokens): r["n"] for r in pieces.groupBy("tokens").agg(F.count("*").alias("n")).collect()}
        slots = expand(spark.createDataFrame(layout(plan(counts, cap)), "length int, first long, k long, container long, slot int"))
        items = ranked(pieces.withColumn("hh", F.xxhash64("h", "piece_no")), ["tokens"], "hh", out="at", ties=("doc_id", "piece_no"))
        got = items.join(slots, (F.col("tokens") == F.col("length")) & (items["at"] == slots["at"])).select(
            F.lit(cid).alias("capacity_id"), "container_id", "slot", "doc_id", "piece_no", (F.col("piece_no").cast("long") * cap).alias("token_from"), F.col("tokens").cast("long").alias("tokens"),
        )
        out = got if out is None else out.unionByName(got)
    return out


def fill_report(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """(capacity_id, capacity_tokens, containers, tokens, fill, full_containers, split_texts)."""
    bins = packed.groupBy("capacity_id", "container_id").agg(F.sum("tokens").alias("t"), F.max((F.col("piece_no") > 0).cast("int")).alias("cut"))
    by = bins.join(small(capacities), "capacity_id").groupBy("capacity_id", "capacity_tokens").agg(
        F.count("*").alias("containers"), F.sum("t").alias("tokens"), F.count_if(F.col("t") == F.col("capacity_tokens")).alias("full_containers"), F.count_if(F.col("t") > F.col("capacity_tokens")).alias("over_full"),
    )
    return by.withColumn("fill", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6))
