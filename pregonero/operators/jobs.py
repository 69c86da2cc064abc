"""Jobs that write: versioned tables with a unique key, partition overwrite, quarantine, and the gold view of lots."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def publish(rows: DataFrame, base: str, key: list[str], partition: str | None = None) -> str:
    """SNK8: write a new version of a table under `base` and point to it. Readers of the old version go on; a repeated
    key stops the job before the pointer moves."""
    spark = rows.sparkSession
    path = f"{base}/v-{uuid.uuid4().hex}"
    writer = rows.write.partitionBy(partition) if partition else rows.write
    writer.parquet(path)
    new = spark.read.schema(rows.schema).parquet(path)
    if not new.groupBy(*key).count().where("count > 1").isEmpty():
        raise ValueError(f"the key {key} isn't unique")
    turn = 1 + (spark.read.text(f"{base}/pointer").count() if _exists(spark, f"{base}/pointer") else 0)
    spark.createDataFrame([(f"{turn:09d} {path} {rows._jdf.schema().json()}",)], "value string").coalesce(1).write.mode("append").text(f"{base}/pointer")
    return path


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def current(spark: SparkSession, base: str) -> DataFrame:
    """The version that the pointer names."""
    from pyspark.sql.types import StructType
    import json

    last = spark.read.text(f"{base}/pointer").agg(F.max("value")).first()[0]
    _, path, schema = last.split(" ", 2)
    return spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(path)


def overwrite_partitions(rows: DataFrame, path: str, partition: str) -> None:
    """UPS13: replace the partitions that occur in rows, keep the others; running it twice changes nothing."""
    rows.repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def quarantine(rows: DataFrame, good: Column) -> tuple[DataFrame, DataFrame]:
    """SNK6: (rows that hold, rows that don't or are unknown)."""
    ok = F.coalesce(good, F.lit(False))
    return rows.where(ok), rows.where(~ok)


def lot_search(lots: DataFrame, units: DataFrame, places: DataFrame, links: DataFrame) -> DataFrame:
    """The public list of lots: one row per lot that isn't the secondary of another, with its unit and place."""
    shown = lots.select("id", "minimum_bid", "current_status", "spatial_unit_id").join(links.select(F.col("secondary_lot_id").alias("id")), "id", "left_anti")
    unit = units.select(F.col("id").alias("spatial_unit_id"), "kind", "address_id")
    place = places.select(F.col("id").alias("address_id"), "uf", "municipality_code")
    return shown.join(unit, "spatial_unit_id", "left").join(place, "address_id", "left")


def markdown_table(rows: DataFrame, columns: list[str], most: int = 1000) -> str:
    """SNK4: the first rows of a small, ordered result as a Markdown table; the numbers are made in Spark, only the text here."""
    lines = ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    lines += ["| " + " | ".join("" if r[c] is None else str(r[c]).replace("|", "\\|") for c in columns) + " |" for r in rows.select(*columns).limit(most).collect()]
    return "\n".join(lines)


def write_csv(rows: DataFrame, columns: list[str], path: str) -> None:
    """SNK3: a fixed order of columns; missing ones are empty, others are left out."""
    rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns]).write.mode("overwrite").option("header", True).csv(path)


def patch_csv(spark: SparkSession, old: str, new: str, patch: DataFrame, key: str) -> None:
    """SNK9: the rows of a CSV folder with the values of patch where it has some, written to another folder, so a broken run
    leaves the old one whole."""
    rows = spark.read.option("header", True).csv(old)
    cols = [c for c in patch.columns if c != key]
    fresh = patch.select(key, *[F.col(c).cast("string").alias(f"__{c}") for c in cols])
    got = rows.join(fresh, key, "left").select(*[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in cols else F.col(c) for c in rows.columns])
    got.write.mode("overwrite").option("header", True).csv(new)


def stamp_changes(old: DataFrame, new: DataFrame, key: str, columns: list[str], at: Column) -> DataFrame:
    """FN21: old rows with the columns of new where given; updated_at is `at` where a column really changes."""
    fresh = new.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    got = old.join(fresh, key, "left")
    changed = F.lit(False)
    for c in columns:
        changed = changed | (F.col(f"__{c}").isNotNull() & ~F.col(f"__{c}").eqNullSafe(F.col(c)))
    out = got.withColumn("updated_at", F.when(changed, at).otherwise(F.col("updated_at")))
    return out.select(*[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in old.columns])
