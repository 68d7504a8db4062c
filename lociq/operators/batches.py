"""Batches, status roll-ups, record collection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociq.operators.ranking import global_row_number


def round_robin(meta: DataFrame, batches: int) -> DataFrame:
    """Rows with a batch (from 0): organisms by count, their rows in a fixed shuffle, dealt in turn. Rows without organism get none."""
    named = meta.where("organism IS NOT NULL")
    counts = named.groupBy("organism").agg(F.count(F.lit(1)).alias("org_count"))
    placed = named.join(counts, "organism").withColumn("place", F.md5(F.col("srr_accession").cast("string")))
    numbered = global_row_number(placed, [F.desc("org_count"), F.col("organism"), F.col("place"), F.col("srr_accession")], "k")
    return numbered.select("srr_accession", "organism", ((F.col("k") - 1) % batches).alias("batch"))


def chunks(units: DataFrame, key: str, nodes: int) -> DataFrame:
    """Units in order of key with a chunk (from 0): `nodes` runs of ceil(n / nodes)."""
    n = units.count()
    size = max(1, -(-n // nodes))
    return global_row_number(units, [F.col(key)], "k").withColumn("chunk", F.floor((F.col("k") - 1) / size)).drop("k")


def status_rollup(status: DataFrame) -> DataFrame:
    """ok and total of each batch, and of all (batch null)."""
    return status.rollup("batch").agg(F.count_if(F.col("status") == "ok").alias("n_ok"), F.count(F.lit(1)).alias("n_total"), F.grouping("batch").cast("int").alias("is_total"))


def completeness(samples: DataFrame, done: DataFrame) -> DataFrame:
    """Of each batch, how many samples have an output."""
    d = done.select("sample_id").distinct().withColumn("has", F.lit(True))
    return samples.join(d, "sample_id", "left").groupBy("batch").agg(F.count_if(F.col("has")).alias("n_with"), F.count_if(F.col("has").isNull()).alias("n_without"))


def value_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def layout_report(listing: DataFrame, rules: DataFrame) -> DataFrame:
    """Each folder of a listing (batch, name) against rules (name, kind: required, optional, legacy): missing, unknown, or its kind."""
    wanted = listing.select("batch").distinct().join(F.broadcast(rules.where("kind = 'required'").select("name")))
    found = listing.select("batch", "name").distinct().join(rules, "name", "left").select("batch", "name", F.coalesce("kind", F.lit("unknown")).alias("state"))
    missing = wanted.join(found, ["batch", "name"], "left_anti").select("batch", "name", F.lit("missing").alias("state"))
    return found.unionByName(missing)


def collect_records(first: DataFrame, second: DataFrame) -> DataFrame:
    """Records of both sources by is_id; the first source wins."""
    rest = second.join(first.select("is_id"), "is_id", "left_anti")
    return first.withColumn("source", F.lit("first")).unionByName(rest.withColumn("source", F.lit("second")), allowMissingColumns=True)


def systems_summary(records: DataFrame, orfs: DataFrame, partial: DataFrame, min_orf: int = 100) -> DataFrame:
    """Records with guide hits, tail-head reads and a long ORF, and whether they have a partial circle."""
    longest = orfs.groupBy("is_id").agg(F.max(F.col("orf_end") - F.col("orf_start") + 1).alias("longest_nt"))
    p = partial.select("is_id").distinct().withColumn("has_partial_circle", F.lit(True))
    r = records.where("n_guide_hits > 0 AND n_th_reads > 0").join(longest, "is_id", "left").where(F.coalesce("longest_nt", F.lit(0)) >= min_orf)
    return r.join(p, "is_id", "left").withColumn("has_partial_circle", F.coalesce("has_partial_circle", F.lit(False)))
