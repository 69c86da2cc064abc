"""Relational operators as DataFrame -> DataFrame: first rows, top-k, update joins, upsert folds, linkage, matching, checks,
profiles. Every choice of a row has a total order, so results don't depend on partitioning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pregonero.functions.parsers import haversine_km, trigrams


def first_by(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """WIN3/4/5: the first row per key in a total order."""
    return rows.withColumn("__k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__k = 1").drop("__k")


def top_k(rows: DataFrame, keys: list[str], order: list[Column], k: int, out: str = "k") -> DataFrame:
    """WIN1: the first k rows per key with their place. The limit of the rank is pushed before the shuffle by Catalyst
    (WindowGroupLimit), so a large key sends k rows per task."""
    return rows.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(out) <= k)


def left_chain(base: DataFrame, others: list[tuple[DataFrame, str]]) -> DataFrame:
    """J2: left joins in turn, each by one equal column."""
    return reduce(lambda a, b: a.join(b[0], b[1], "left"), others, base)


def update_from(target: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """SRC11/J12/UPS6: new values where there are some, else the old; rows without a match stay."""
    fresh = new.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    return target.join(fresh, keys, "left").select(*[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


def upsert_fold(observations: DataFrame, keys: list[str], order: list[str], policy: dict[str, str | tuple[str, str]]) -> DataFrame:
    """UPS3-5/7: many observations per key folded in order. overwrite: the last value even if null; coalesce: the last one
    that isn't null; keep: the first; (last_not, v) and (first_not, v): the last or first that is neither null nor the
    default v, else v. One aggregation with partial folding, no window and no MERGE."""
    at = F.struct(*[F.coalesce(F.col(c).cast("timestamp"), F.lit(0).cast("timestamp")) if observations.schema[c].dataType.simpleString() == "timestamp" else F.col(c) for c in order])
    fold = {
        "overwrite": lambda c: F.max_by(F.struct(c), at)[c],
        "coalesce": lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)),
        "keep": lambda c: F.min_by(F.struct(c), at)[c],
    }
    known = lambda c, v: F.when(F.col(c).isNotNull() & (F.col(c) != v), at)

    def one(c: str, how: str | tuple[str, str]) -> Column:
        if isinstance(how, str):
            return fold[how](c)
        return F.coalesce((F.max_by if how[0] == "last_not" else F.min_by)(F.col(c), known(c, how[1])), F.lit(how[1]))

    return observations.groupBy(*keys).agg(*[one(c, how).alias(c) for c, how in policy.items()])


def replace_children(old: DataFrame, new: DataFrame, parent: list[str]) -> DataFrame:
    """UPS9: the children of parents that occur in `new` are replaced, others stay."""
    return old.join(new.select(*parent).distinct(), parent, "left_anti").unionByName(new)


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """UPS11: rows of `new` whose key is unknown are added."""
    return old.unionByName(new.join(old.select(*keys).distinct(), keys, "left_anti"))


def ordered_children(rows: DataFrame, parent: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """J6/AGG6: children of a parent as an array of structs in order."""
    cols = [*order, *[c for c in columns if c not in order]]
    return rows.groupBy(*parent).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("children"))


def matches_by_any_key(rows: DataFrame, id_col: str, keys: list[str], most: int = 5) -> DataFrame:
    """J9: (id, match, place): the first `most` other ids, by size, that agree with a record in any key. Of every value of a
    key only its smallest most + 1 ids are joined back, which hold all that can be among the first, so a value that
    many records share is no product; an OR condition would be a nested-loop join."""
    ids = rows.select(F.col(id_col).alias("i"), *keys)
    parts = []
    for k in keys:
        side = ids.where(F.col(k).isNotNull()).select(F.col(k).alias("k"), "i").distinct()
        few = top_k(side, ["k"], [F.col("i").asc()], most + 1, "__few").select("k", F.col("i").alias("match"))
        parts.append(side.join(few, "k").where(F.col("i") != F.col("match")).select("i", "match"))
    both = reduce(DataFrame.unionByName, parts).distinct()
    return top_k(both, ["i"], [F.col("match").asc()], most, "place").withColumnRenamed("i", id_col)


def bank_links(lots: DataFrame) -> DataFrame:
    """UPS12: (secondary, canonical, match_kind, confidence): every lot of a bank that shares its address or registry key with
    a lot of another kind of source is secondary to the smallest such lot. lots: (id, kind, address_key,
    registry_key). What kind of match it is follows from the keys that the bank's lot has. Only minima per key are joined."""
    of = lambda k, out: lots.where((F.col("kind") != "bank") & F.col(k).isNotNull()).groupBy(k).agg(F.min("id").alias(out))
    got = lots.where("kind = 'bank'").join(of("address_key", "__a"), "address_key", "left").join(of("registry_key", "__r"), "registry_key", "left")
    both, reg = F.col("address_key").isNotNull() & F.col("registry_key").isNotNull(), F.col("registry_key").isNotNull()
    return got.where("__a is not null or __r is not null").select(
        F.col("id").alias("secondary"), F.least("__a", "__r").alias("canonical"), F.when(both, "address+registry").when(reg, "registry").otherwise("address").alias("match_kind"), F.when(both, 90).when(reg, 70).otherwise(55).alias("confidence"),
    )


def merge_registries(left: DataFrame, right: DataFrame) -> DataFrame:
    """J13/SET5: (source_kind, left_id, right_id) of two registries with (id, number, board, name, extras), extras the further
    (number, board) of a left record. A left record takes the right one of its number and board, else the largest of its
    extras', else one of its name: the smallest of its board, or the only one. All right records that extras name count
    as matched; what is left of the right side is appended."""
    by_number = right.where("number is not null and board is not null").groupBy("number", "board").agg(F.max("id").alias("r"))
    own = left.join(by_number, ["number", "board"]).select(F.col("id").alias("left_id"), F.col("r").alias("own"))
    told = left.select(F.col("id").alias("left_id"), F.explode("extras").alias("x")).select("left_id", "x.number", "x.board").join(by_number, ["number", "board"])
    extra = told.groupBy("left_id").agg(F.max("r").alias("extra"))
    named = right.where("name <> ''")
    same = named.where("board is not null").groupBy("name", "board").agg(F.min("id").alias("same"))
    once = named.groupBy("name").agg(F.min("id").alias("only"), F.count("*").alias("n")).where("n = 1").drop("n")
    got = left.select(F.col("id").alias("left_id"), "name", "board").join(own, "left_id", "left").join(extra, "left_id", "left").join(same, ["name", "board"], "left").join(once, "name", "left")
    matched = got.select("left_id", F.coalesce("own", "extra", "same", "only").alias("right_id"))
    used = matched.where("right_id is not null").select(F.col("right_id").alias("id")).unionByName(told.select(F.col("r").alias("id"))).distinct()
    rest = right.select("id").join(used, "id", "left_anti").select(F.lit("right_only").alias("source_kind"), F.lit(None).cast("long").alias("left_id"), F.col("id").alias("right_id"))
    return matched.select(F.when(F.col("right_id").isNotNull(), "both").otherwise("left_only").alias("source_kind"), "left_id", "right_id").unionByName(rest)


def cached_lookup(asked: DataFrame, cache: DataFrame, key: str, as_of: Column, days: int) -> DataFrame:
    """J17: asked with outcome: hit, negative (known to give nothing), expired or miss. cache: (key, found, at), the latest
    entry of a key counts."""
    last = cache.groupBy(key).agg(F.max_by("found", "at").alias("__found"), F.max("at").alias("__at"))
    got = asked.join(last, key, "left")
    old = F.col("__at") < as_of - F.make_interval(days=F.lit(days))
    return got.withColumn("outcome", F.when(F.col("__at").isNull(), "miss").when(old, "expired").when(F.col("__found"), "hit").otherwise("negative")).drop("__found", "__at")


def trigram_match(names: DataFrame, reference: DataFrame, name: str, of: str, block: str, code: str, least: float) -> DataFrame:
    """J8: exact match in the block, else the best trigram similarity of at least `least`; ties to the smaller code.
    Trigrams are made once per name, and candidates share one, so a block isn't crossed."""
    n = names.withColumn("x", trigrams(F.col(name)))
    r = reference.withColumn("y", trigrams(F.col(of)))
    hit = n.select(name, block, F.size("x").alias("nx"), F.explode("x").alias("t")).join(r.select(of, block, code, F.size("y").alias("ny"), F.explode("y").alias("t")), [block, "t"])
    both = hit.groupBy(name, block, of, code, "nx", "ny").agg(F.count("*").alias("shared"))
    sim = F.col("shared") / (F.col("nx") + F.col("ny") - F.col("shared"))
    good = both.withColumn("sim", F.round(sim, 9)).withColumn("exact", F.col(name) == F.col(of)).where((F.col("sim") >= least) | F.col("exact"))
    return first_by(good, [name, block], [F.col("exact").desc(), F.col("sim").desc(), F.col(code).asc()]).select(name, block, code)


def within_km(points: DataFrame, lat: float, lon: float, km: float, lat_col: str = "lat", lon_col: str = "lon") -> DataFrame:
    """J10: points within a distance, with it. A box around the centre goes to the scan, the exact distance follows."""
    import math

    dy = km / 111.0
    dx = dy / max(0.05, math.cos(math.radians(min(89.0, abs(lat) + dy))))
    box = points.where(F.col(lat_col).between(lat - dy, lat + dy) & F.col(lon_col).between(lon - dx, lon + dx))
    return box.withColumn("km", haversine_km(F.lit(lat), F.lit(lon), F.col(lat_col), F.col(lon_col))).where(F.col("km") <= km)


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    """AGG10: counts and percentages, with missing values as (none)."""
    n = rows.groupBy(F.coalesce(F.col(column), F.lit("(none)")).alias("value")).agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("all"))
    return n.crossJoin(F.broadcast(total)).select("value", "n", F.round(F.col("n") * 100.0 / F.col("all"), 4).cast("decimal(9,4)").alias("pct"))


def histogram(rows: DataFrame, column: str, upper: list[tuple[str, float]], rest: str) -> DataFrame:
    """AGG11: half-open ranges by their upper ends, and missing values."""
    bucket = F.when(F.col(column).isNull(), "(none)")
    for label, end in upper:
        bucket = bucket.when(F.col(column) < end, label)
    return rows.groupBy(bucket.otherwise(rest).alias("bucket")).agg(F.count("*").alias("n"))


def _filled(column: str) -> Column:
    c = F.col(column)
    return F.when(c.isNotNull() & ~F.coalesce(c.cast("string"), F.lit("")).isin("", "[]", "{}"), 1.0).otherwise(0.0)


def fill_rates(rows: DataFrame, columns: list[str]) -> DataFrame:
    """PRJ35/AGG13: share of filled values per column in one pass."""
    return rows.agg(*[F.round(F.avg(_filled(c)), 6).cast("decimal(9,6)").alias(c) for c in columns])


def gap_scores(rows: DataFrame, weights: dict[str, int]) -> DataFrame:
    """AGG13: (field, gap): missing share times weight."""
    one = rows.agg(*[F.avg(F.col(c).isNotNull().cast("int")).alias(c) for c in weights])
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.round((1 - F.col(c)) * w, 2).cast("decimal(9,2)").alias("gap")) for c, w in weights.items()])
    return one.select(F.inline(pairs))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """SET2: rows per table."""
    return reduce(DataFrame.unionByName, [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("t"), "n") for name, t in tables.items()])


def first_failure(checks: list[tuple[str, Column]]) -> Column:
    """FLT1: name of the first check that doesn't hold, or null."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks])


def failure_list(checks: dict[str, Column]) -> Column:
    """DQ5/6: names of all checks that don't hold, in order."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))


def failed_checks(rows: DataFrame, id_col: str, checks: dict[str, Column]) -> DataFrame:
    """DQ2: (id, failed) for checks that are false; unknown isn't a failure."""
    failed = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in checks.items()]))
    return rows.select(id_col, F.explode(failed).alias("failed"))


def domain_violations(rows: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """DQ1: (field, violations) per pattern in one pass; null isn't a violation."""
    one = rows.agg(*[F.count_if(F.col(c).isNotNull() & ~F.col(c).rlike(p)).alias(c) for c, p in patterns.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("violations")) for c in patterns])))


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """DQ3: keys that occur more than once."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def fixed_domain_counts(rows: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """SNK5: counts of a fixed list of values, zero where there are none."""
    values = rows.sparkSession.createDataFrame([(v,) for v in domain], f"{column} string")
    return F.broadcast(values).join(rows.groupBy(column).agg(F.count("*").alias("n")), column, "left").fillna(0, ["n"])
