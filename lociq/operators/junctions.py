"""Junction reads on doubled consensus targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TYPES = ("tail_head", "genome_head", "tail_genome")


def junction_types(n: Column, overlap: int = 100, tolerance: int = 50) -> Column:
    """The junction kinds an alignment shows on a target of two copies of n bases; kinds do not exclude each other."""
    rs, re, left, right = F.col("ref_start"), F.col("ref_end"), F.col("left_clip"), F.col("right_clip")
    aligned = re - rs >= overlap
    found = (
        (rs <= n - overlap) & (re >= n + overlap),
        (left >= overlap) & aligned & ((rs < tolerance) | (F.abs(rs - n) < tolerance)),
        (right >= overlap) & aligned & ((F.abs(re - n) < tolerance) | (F.abs(re - 2 * n) < tolerance)),
    )
    return F.array_compact(F.array(*[F.when(c, F.lit(t)) for c, t in zip(found, TYPES, strict=True)]))


def mapped(alignments: DataFrame, supplementary: bool = True) -> DataFrame:
    """Alignments with a flag column that are mapped and not secondary (nor supplementary if told)."""
    return alignments.where(F.col("flag").bitwiseAND(F.lit(0x4 | 0x100 | (0 if supplementary else 0x800))) == 0)


def classified(alignments: DataFrame, targets: DataFrame, overlap: int = 100, tolerance: int = 50) -> DataFrame:
    """Alignments on known targets with `types`; targets has ref_id, uuid, n. Alignments on unknown targets go."""
    return alignments.join(targets, "ref_id").withColumn("types", junction_types(F.col("n"), overlap, tolerance))


def junction_reads(found: DataFrame) -> DataFrame:
    """One row for each alignment and kind."""
    return found.withColumn("junction_type", F.explode("types")).drop("types")


def junction_summary(found: DataFrame, targets: DataFrame) -> DataFrame:
    """Counts of each kind for every target; targets without alignments have zeros."""
    counts = found.groupBy("uuid").agg(*[F.count_if(F.array_contains("types", t)).alias(f"n_{t}_reads") for t in TYPES], F.count(F.lit(1)).alias("n_total_mapped"))
    numbers = [f"n_{t}_reads" for t in TYPES] + ["n_total_mapped"]
    return targets.join(counts, "uuid", "left").select("uuid", "n", *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers])


def example_reads(found: DataFrame, kind: str = "tail_head") -> DataFrame:
    """For each target the read of the best mapping quality, then the longest, then the first."""
    rows = found.where(F.array_contains("types", kind))
    return rows.groupBy("uuid").agg(F.max_by("read_id", F.struct("mapq", F.col("ref_end") - F.col("ref_start"), -F.col("read_id"), -F.col("seg"))).alias("example_read"))


def bait(elements: DataFrame) -> DataFrame:
    """Targets of two copies of each consensus, named by element and junction position."""
    n = F.length("consensus")
    return elements.select(F.concat(F.col("uuid"), F.lit("__th__j"), n.cast("string")).alias("ref_name"), F.lit("tail_head").alias("type"), n.cast("long").alias("position"), "uuid", F.concat("consensus", "consensus").alias("sequence"))
