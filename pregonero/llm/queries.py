"""Queries of the operators for training data over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pregonero.llm import abuse, addresses, canonical_list, components, entities, mixing, packing, survivors, tokens
from pregonero.operators.money import amount_values, convert_amounts
from pregonero.session import small, table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.same_entity_pairs(entities.resolve(table(spark, sf_dir, "auctioneers_unified")))


def p2_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record with its entity, the smallest record of it, instead of pairs."""
    return entities.named_by_smallest(entities.resolve(table(spark, sf_dir, "auctioneers_unified")))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.canonical_groups(table(spark, sf_dir, "lot_canonical_link"))


def _addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses.parse_addresses(addresses.with_city(table(spark, sf_dir, "address"), table(spark, sf_dir, "ref_municipality")))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses.same_location_pairs(addresses.locate(_addresses(spark, sf_dir)))


def p4_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per located address with its location, instead of pairs."""
    return addresses.locate(_addresses(spark, sf_dir)).select(F.col("id").alias("address_id"), "location")


def p4_unlocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses.unlocated(_addresses(spark, sf_dir)).select(F.col("id").alias("address_id"), "reason")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = canonical_list.municipalities(table(spark, sf_dir, "address"), table(spark, sf_dir, "ref_municipality"))
    return got.select("address_id", "municipality_code").distinct()


def _lots_in_centavos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert_amounts(amount_values(spark, sf_dir)["appraisal_value"], keep=["id", "source_short_name", "source_lot_code", "description", "confidence_score", "scraped_at"])


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = survivors.spatial_unit_survivors(table(spark, sf_dir, "spatial_unit"))
    lots = survivors.auction_lot_survivors(_lots_in_centavos(spark, sf_dir), sources=table(spark, sf_dir, "auction_lot"))
    one = lambda df, t: df.select(F.lit(t).alias("table_name"), "group_id", "field_name", "row_id")
    return one(units, "spatial_unit").unionByName(one(lots, "auction_lot"))


def p7_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value judged true: of a field of several values, all of them."""
    units = survivors.true_values(table(spark, sf_dir, "spatial_unit"), *survivors.UNIT_COLUMNS, survivors.spatial_unit_fields())
    lots = survivors.true_values(_lots_in_centavos(spark, sf_dir), *survivors.LOT_COLUMNS, survivors.auction_lot_fields(), table(spark, sf_dir, "auction_lot"))
    one = lambda df, t: df.select(F.lit(t).alias("table_name"), "group_id", "field_name", "row_id", F.round("probability", 4).alias("probability"))
    return one(units, "spatial_unit").unionByName(one(lots, "auction_lot"))


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.with_tokens(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    capacities = [(r.capacity_id, r.capacity_tokens) for r in table(spark, sf_dir, "pack_capacity").collect()]
    return packing.pack(_sized(spark, sf_dir), capacities)


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir)


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(_packed(spark, sf_dir), table(spark, sf_dir, "pack_capacity"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_sized(spark, sf_dir), table(spark, sf_dir, "mix_target"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(p9_mix(spark, sf_dir), table(spark, sf_dir, "mix_target"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return abuse.score_documents(documents, abuse.fit(table(spark, sf_dir, "review_example"))).drop("text")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).where(F.col("abuse_score") >= abuse.ACCEPT).select("doc_id").distinct()


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("doc_id", F.round("abuse_score", 4).alias("abuse_score"), (F.col("abuse_score") >= abuse.ACCEPT).alias("abusive"))


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = (F.col("abuse_score") >= abuse.ACCEPT).cast("long")
    return _scored(spark, sf_dir).groupBy("source").agg(F.count("*").alias("documents"), F.sum(hit).alias("abusive"), F.round(F.avg(hit), 6).alias("rate"))


def p8_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the containers: every text with letters is in one, none is over its capacity, and no text that
    fits into one is split."""
    packed = _packed(spark, sf_dir)
    capacities = small(table(spark, sf_dir, "pack_capacity"))
    bins = packed.groupBy("capacity_id", "container_id").agg(F.sum("tokens").alias("t")).join(capacities, "capacity_id")
    over = bins.groupBy("capacity_id").agg(F.count_if(F.col("t") > F.col("capacity_tokens")).alias("over_full"))
    texts = packed.groupBy("capacity_id", "doc_id").agg(F.sum("tokens").alias("t"), F.max("piece_no").alias("p")).join(capacities, "capacity_id")
    split = (F.col("t") <= F.col("capacity_tokens")) & (F.col("p") > 0)
    return texts.groupBy("capacity_id").agg(F.count_distinct("doc_id").alias("texts"), F.count_if(split).alias("split_short")).join(over, "capacity_id")


def p9_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the mix: no text is used too often, and no share is off its target by more than the largest texts
    of the sources together, as texts stay whole."""
    got = p9_shares(spark, sf_dir)
    largest = _sized(spark, sf_dir).groupBy("source").agg(F.max("tokens").alias("most")).join(table(spark, sf_dir, "mix_target").select("source"), "source").agg(F.sum("most").alias("slack"))
    bound = got.agg(F.sum("tokens").alias("all")).crossJoin(F.broadcast(largest))
    near = F.abs(F.col("actual_share") - F.col("target_share")) * F.col("all") <= F.col("slack")
    yes = lambda c: F.when(c, "yes").otherwise("no")
    return got.crossJoin(F.broadcast(bound)).select("source", yes(F.col("most_uses") <= F.col("max_repeats")).alias("within_repeats"), yes(near).alias("on_target"))


def p10_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document has a score: documents per source, and those without letters among the lowest."""
    got = _scored(spark, sf_dir)
    return got.groupBy("source").agg(F.count("abuse_score").alias("documents"), F.count_if(F.col("abuse_score").isNull()).alias("unscored"))


QUERIES = {"p2_found": p2_found, "p2_entities": p2_entities, "p3_found": p3_found, "p4_found": p4_found, "p4_locations": p4_locations, "p4_unlocated": p4_unlocated, "p5_found": p5_found, "p7_found": p7_found, "p7_values": p7_values, "p8_containers": p8_containers, "p8_fill": p8_fill, "p8_checked": p8_checked, "p9_mix": p9_mix, "p9_shares": p9_shares, "p9_checked": p9_checked, "p10_found": p10_found, "p10_scores": p10_scores, "p10_rates": p10_rates, "p10_checked": p10_checked}
ORACLE_SQL = {
    "p3_found": """
WITH RECURSIVE e AS (
  SELECT DISTINCT canonical_lot_id a, secondary_lot_id b FROM lot_canonical_link
  WHERE canonical_lot_id <> secondary_lot_id AND regexp_replace(lower(coalesce(match_kind, '')), '[^a-z]', '', 'g') <> 'none'),
sym AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
walk AS (SELECT a AS id, a AS seen FROM sym UNION SELECT w.id, x.b FROM walk w JOIN sym x ON x.a = w.seen)
SELECT id AS lot_id, min(seen) AS group_id FROM walk GROUP BY id""",
    "p8_checked": "SELECT capacity_id, (SELECT count(DISTINCT doc_id) FROM documents WHERE length(text) > 0) AS texts, CAST(0 AS BIGINT) AS split_short, CAST(0 AS BIGINT) AS over_full FROM pack_capacity",
    "p9_checked": "SELECT source, 'yes' AS within_repeats, 'yes' AS on_target FROM mix_target",
    "p10_checked": "SELECT source, count(*) AS documents, CAST(0 AS BIGINT) AS unscored FROM documents GROUP BY 1",
}
