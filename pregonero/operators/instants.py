"""Problem 1: the timestamp fields of the lake as instants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pregonero.functions.timestamps import with_utc_micros
from pregonero.session import small, table

CANONICAL = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$"


def timestamp_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table_name, row_id, field_name, item_no, source, value) of the four timestamp fields."""
    fetch = table(spark, sf_dir, "fetch_event").select(
        F.lit("fetch_event").alias("table_name"), F.col("id").alias("row_id"), F.lit("fetched_at").alias("field_name"),
        F.lit(0).cast("long").alias("item_no"), F.col("source_short_name").alias("source"), F.col("fetched_at").alias("value"),
    )
    pilot = table(spark, sf_dir, "pilot_item").select("item_id", "auctioneer_slug", F.explode("rounds").alias("r")).select(
        F.lit("pilot_item").alias("table_name"), F.col("item_id").alias("row_id"), F.lit("scheduled_at").alias("field_name"),
        F.col("r.round_number").cast("long").alias("item_no"), F.col("auctioneer_slug").alias("source"), F.col("r.scheduled_at").alias("value"),
    )
    # one scan for both dates of the probe
    probe = table(spark, sf_dir, "probe2_imoveis_with_bid").select(
        "id", "source_short_name", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in ("auction_date_init", "auction_date_end")])).alias("x"),
    ).select(
        F.lit("probe2_imoveis_with_bid").alias("table_name"), F.col("id").alias("row_id"), F.col("x.f").alias("field_name"),
        F.lit(0).cast("long").alias("item_no"), F.col("source_short_name").alias("source"), F.col("x.v").alias("value"),
    )
    return fetch.unionByName(pilot).unionByName(probe)


def normalise_instants(values: DataFrame, sources: DataFrame) -> DataFrame:
    """Distinct (table_name, row_id, field_name, item_no, utc_us) of the values that denote exactly one instant
    and aren't in the canonical form yet. A source that isn't listed has no clock: its values without a zone are
    left out. Repeated rows come out once. The source list is broadcast only if it is counted to be small."""
    clocks = small(
        sources.where(F.col("short_name").isNotNull()).groupBy("short_name").agg(F.min("time_zone").alias("__zone"), F.min("date_order").alias("__order")),
        10_000,
    )
    rest = values.where(F.col("value").isNotNull() & ~F.col("value").rlike(CANONICAL))
    known = rest.join(clocks, rest.source == clocks.short_name, "left").drop("short_name")
    return (
        with_utc_micros(known, "value", "__zone", "__order")
        .where(F.col("utc_us").isNotNull())
        .select("table_name", "row_id", "field_name", "item_no", "utc_us")
        .distinct()
    )
