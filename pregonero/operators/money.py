"""Problem 6: the amounts of the lake in centavos."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pregonero.functions.amounts import fit_units, read_amounts, stated_unit, with_centavos
from pregonero.session import table

CANONICAL = r"^[0-9]+\.[0-9]{2}$"


def amount_values(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Per field: (table_name, row_id, field_name, item_no, value, text1, text2, anchor)."""
    cols = lambda t, i, f, n, v, t1, t2, a: (
        F.lit(t).alias("table_name"), F.col(i).alias("row_id"), F.lit(f).alias("field_name"), n.cast("long").alias("item_no"),
        F.col(v).alias("value"), F.col(t1).alias("text1"), F.col(t2).alias("text2"), a.cast("double").alias("anchor"),
    )
    pilot = table(spark, sf_dir, "pilot_item").select("item_id", "title", "description", "market_value_brl", F.explode("rounds").alias("r"))
    probe = table(spark, sf_dir, "probe2_imoveis_with_bid")
    lots = table(spark, sf_dir, "auction_lot")
    return {
        "minimum_bid_brl": pilot.select(*cols("pilot_item", "item_id", "minimum_bid_brl", F.col("r.round_number"), "r.minimum_bid_brl", "title", "description", F.col("market_value_brl"))),
        "bid_initial": probe.select(*cols("probe2_imoveis_with_bid", "id", "bid_initial", F.lit(0), "bid_initial", "lot_title", "lot_description", F.lit(None))),
        "appraisal_value": lots.select("id", "source_short_name", "source_lot_code", "description", "confidence_score", "scraped_at", *cols("auction_lot", "id", "appraisal_value", F.lit(0), "appraisal_value", "lot_number", "description", F.col("minimum_bid"))),
    }


def convert_amounts(values: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """keep: columns to carry along, by default those that name a value. One field's amounts in centavos with the unit taken and its posterior. The hint of a record's texts is looked
    for only where a number has no unit of its own. Rows without an amount keep null centavos."""
    values = values.select(*(keep or ["table_name", "row_id", "field_name", "item_no"]), "value", "text1", "text2", "anchor")
    read = read_amounts(values, "value", stated_unit(F.col("text1"), F.col("text2")))
    model = fit_units(read, F.col("anchor"))
    return with_centavos(read, model, F.col("anchor"))


def found_amounts(values: dict[str, DataFrame]) -> DataFrame:
    """Distinct (table_name, row_id, field_name, item_no, centavos) of the values that state an amount and aren't that
    amount in reais with a point and two decimals yet."""
    out = None
    for df in values.values():
        got = convert_amounts(df.where(F.col("value").isNotNull()))
        plain_cents = F.when(F.col("value").rlike(CANONICAL), F.replace(F.col("value"), F.lit(".")).try_cast("long"))
        rows = got.where(F.col("centavos").isNotNull() & ~F.coalesce(plain_cents == F.col("centavos"), F.lit(False)))
        rows = rows.select("table_name", "row_id", "field_name", "item_no", "centavos")
        out = rows if out is None else out.unionByName(rows)
    return out.distinct()


def unit_report(values: dict[str, DataFrame]) -> DataFrame:
    """Distinct (table_name, row_id, field_name, item_no, centavos, unit, posterior, uncertain) of all values that state an
    amount. posterior is 1 where the value or its record states the unit; uncertain means a posterior under 0.95."""
    cols = ("table_name", "row_id", "field_name", "item_no", "centavos", "unit", F.round("posterior", 4).alias("posterior"), "uncertain")
    parts = [convert_amounts(df.where(F.col("value").isNotNull())).where(F.col("centavos").isNotNull()).select(*cols) for df in values.values()]
    return reduce(DataFrame.unionByName, parts).distinct()
