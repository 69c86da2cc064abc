"""Structured Streaming forms of the incremental jobs; batch results are the reference. A job keeps its state and its
result in the folder it is given, so a job that is started again with that folder goes on where it stopped; without one
it starts anew in a folder of its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pregonero.sources.readers import new_folder


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files."""
    return spark.readStream.schema(spark.read.parquet(f"{sf_dir}/{name}.parquet").schema).parquet(f"{sf_dir}/{name}.parquet*")


def run(stream: DataFrame, base: str, mode: str, write: Callable[[DataFrame, int], None]) -> None:
    """Run a stream over what there is, batch by batch, with its state in the folder base."""
    stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()


def event_totals(spark: SparkSession, sf_dir: str, base: str | None = None) -> DataFrame:
    """Counts and sums per type over all events."""
    base = base or new_folder(spark, "stream")
    totals = _read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total"))
    run(totals, base, "complete", lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{base}/out"))
    return spark.read.parquet(f"{base}/out").select("event_type", "n", F.round("total", 2).cast("decimal(20,2)").alias("total"))


def windowed_counts(events: DataFrame, time: str, keys: list[str], window: str = "24 hours", slide: str = "1 hour", late: str = "7 days") -> DataFrame:
    """Sliding counts per key with a watermark for late events; works on a stream and on a table."""
    return events.withWatermark(time, late).groupBy(F.window(time, window, slide), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def daily_counts(spark: SparkSession, sf_dir: str, base: str | None = None) -> DataFrame:
    """(user_id, start, n) of all events by day. In update mode a window comes again when late events change it; the last
    count of a window is the largest."""
    base = base or new_folder(spark, "stream")
    events = _read(spark, sf_dir, "events")
    kind = events.schema["ts"].dataType
    counts = windowed_counts(events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["user_id"], "1 day", "1 day").withColumn("start", F.col("start").cast(kind))
    run(counts, base, "update", lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{base}/out/epoch={epoch}"))
    return spark.read.parquet(f"{base}/out").groupBy("user_id", "start").agg(F.max("n").alias("n"))


def first_seen(events: DataFrame, keys: list[str], time: str, late: str = "7 days") -> DataFrame:
    """UPS1 as a stream: the first row of each key within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def known_lots(spark: SparkSession, sf_dir: str, base: str | None = None) -> DataFrame:
    """(source_short_name, source_lot_code, outcome, n): lots as they come in, split against the keys known before the batch:
    known ones are only touched, new ones are added. Each batch writes its counts under its own number, so a batch
    that is run again replaces itself and counts once."""
    base = base or new_folder(spark, "stream")
    keys = ["source_short_name", "source_lot_code"]

    def write(batch: DataFrame, epoch: int) -> None:
        batch.groupBy(*keys).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{base}/seen/epoch={epoch}")

    lots = _read(spark, sf_dir, "auction_lot").select(*keys).where(" and ".join(f"{k} is not null" for k in keys))
    run(lots, base, "append", write)
    seen = spark.read.parquet(f"{base}/seen").groupBy(*keys).agg(F.sum("n").alias("n"))
    return seen.select(*keys, F.when(F.col("n") > 1, "seen again").otherwise("new").alias("outcome"), "n")
