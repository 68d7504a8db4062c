"""Incremental forms: new files only, running junction counts, back-jumps of finished reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociq.operators.junctions import TYPES, classified


def stream_parquet(spark: SparkSession, path: str, schema, files: int = 100) -> DataFrame:
    """Files of a folder as they arrive, each once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def running_summary(alignments: DataFrame, targets: DataFrame) -> DataFrame:
    """Junction counts of each target so far (complete or update mode)."""
    found = classified(alignments, targets)
    return found.groupBy("uuid").agg(*[F.count_if(F.array_contains("types", t)).alias(f"n_{t}_reads") for t in TYPES], F.count(F.lit(1)).alias("n_total_mapped"))


def windowed_counts(events: DataFrame, late: str = "1 hour", size: str = "1 day") -> DataFrame:
    """Events of each kind in windows of event time; rows later than `late` are dropped with their window's state."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type")
    return w.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def first_seen(events: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Rows with repeated keys left out while their state lasts."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)
