"""Ranks, first and last rows, deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociq.storage import stored


def global_row_number(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with a row number (from 1, long) over all rows, without one task that sorts them all: rows are dealt by range, numbered
    within their range, and moved by the number of rows in the ranges before. order must be total."""
    dealt = stored(df.repartitionByRange(*order).withColumn("part_", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("part_").agg(F.count(F.lit(1)).alias("k_"))  # a row for each partition
    before = F.sum("k_").over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, 0)) - F.col("k_")
    placed = dealt.join(F.broadcast(counts.select("part_", before.alias("before_"))), "part_")
    return placed.withColumn(name, (F.row_number().over(Window.partitionBy("part_").orderBy(*order)) + F.col("before_")).cast("long")).drop("part_", "before_")


def first_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("turn_", F.row_number().over(w)).where("turn_ = 1").drop("turn_")


def last_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key: what overwriting leaves."""
    return first_by(df, keys, [F.desc_nulls_last(c) for c in order])


def top_by(df: DataFrame, keys: list[str], order: list, n: int, rank: str = "rank") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def ordered_distinct(rank: str, value: str) -> Column:
    """Aggregate: distinct values in order of their first rank."""
    return F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(rank, value))), lambda x: x[value]))


def most_common(df: DataFrame, keys: list[str], value: str, order: str, name: str) -> DataFrame:
    """The value that a key has most often; of several, the one met first by `order`."""
    counts = df.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("k_"), F.min(order).alias("first_"))
    return first_by(counts, keys, [F.desc("k_"), "first_"]).select(*keys, F.col(value).alias(name))


def upper_median(col: Column) -> Column:
    """Aggregate: the element at n div 2 (from 0) of the sorted values."""
    return F.element_at(F.array_sort(F.collect_list(col)), F.floor(F.count(col) / 2).cast("int") + 1)


def upper_median_of(df: DataFrame, value: str, name: str) -> DataFrame:
    """One row: the element at n div 2 (from 0) of the sorted values of all rows, null without any.

    Values are counted, the counts dealt by range, and only the range that holds the middle is searched: no task sees all rows.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("k_"))
    dealt = stored(counts.repartitionByRange(value).withColumn("part_", F.spark_partition_id()), "value-counts")
    upto = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, 0)  # a row for each range
    parts = dealt.groupBy("part_").agg(F.sum("k_").alias("rows_")).withColumn("end_", F.sum("rows_").over(upto))
    middle = parts.withColumn("at_", F.floor(F.sum("rows_").over(Window.partitionBy()) / 2)).where("at_ < end_ AND at_ >= end_ - rows_")
    run = F.sum("k_").over(Window.partitionBy("part_").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    inside = dealt.join(F.broadcast(middle), "part_").withColumn("run_", run + F.col("end_") - F.col("rows_"))
    return inside.where("run_ > at_").agg(F.min(value).alias(name))


def pending(units: DataFrame, finished: DataFrame, keys: list[str]) -> DataFrame:
    """Units whose output does not exist yet."""
    return units.join(finished.select(*keys).distinct(), keys, "left_anti")


def pick_assembly(rows: DataFrame) -> DataFrame:
    """Best assembly for each organism: level, then RefSeq (GCF_) first, then accession."""
    levels = ("Complete Genome", "Chromosome", "Scaffold", "Contig")
    rank = F.coalesce(*[F.when(F.col("level") == x, F.lit(k)) for k, x in enumerate(levels)], F.lit(len(levels)))
    return first_by(rows, ["organism"], [rank, ~F.col("accession").startswith("GCF_"), "accession"])
