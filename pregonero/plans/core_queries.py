"""Queries of the core operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pregonero.operators.instants import normalise_instants, timestamp_values
from pregonero.operators.money import amount_values, found_amounts, unit_report
from pregonero.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_instants(timestamp_values(spark, sf_dir), table(spark, sf_dir, "ref_source"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found_amounts(amount_values(spark, sf_dir))


def p6_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every amount with the unit taken for it, the probability of that unit and whether it is uncertain."""
    return unit_report(amount_values(spark, sf_dir))


QUERIES = {"p1_found": p1_found, "p6_found": p6_found, "p6_amounts": p6_amounts}
ORACLE_SQL: dict[str, str] = {}
