"""Nested elements from alignment blocks of element pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociq.functions.sequence import cigar_blocks


def blocks_of_alignments(paf: DataFrame, min_block: int = 100, min_identity: float = 0.9, min_indel: int = 50) -> DataFrame:
    """query, target, strand, qs, qe, ts, te, matches, aligned of the alignments' blocks, cut at large indels; self hits and poor blocks go.

    An alignment without a CIGAR is one block.
    """
    whole = F.array(F.struct(*[F.col(c).cast("long").alias(n) for c, n in (("query_start", "qs"), ("query_end", "qe"), ("target_start", "ts"), ("target_end", "te"), ("matches", "matches"), ("block_length", "aligned"))]))
    cut = F.when(F.col("cigar").isNull(), whole).otherwise(cigar_blocks(F.col("cigar"), F.col("query_start"), F.col("target_start"), min_indel))
    b = paf.where("query <> target").select("query", "target", "strand", "ordinal", F.explode(cut).alias("b")).select("query", "target", "strand", "ordinal", "b.*")
    return b.where((F.col("aligned") >= min_block) & (F.col("matches") / F.col("aligned") >= min_identity))


def oriented_blocks(blocks: DataFrame, elements: DataFrame, min_ratio: float = 1.02) -> DataFrame:
    """Blocks of each unordered pair with core and host coordinates. The longer element is the host; the query of the pair's first block is
    if both are equally long. elements has id, ext_length. Pairs of too similar length go."""
    pair = F.struct(F.least("query", "target").alias("x"), F.greatest("query", "target").alias("y"))
    b = blocks.withColumn("pair", pair)
    lead = F.first("query").over(Window.partitionBy("pair").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    b = b.withColumn("lead", lead).withColumn("other", F.when(F.col("lead") == F.col("pair.x"), F.col("pair.y")).otherwise(F.col("pair.x")))
    size = lambda name, n: elements.select(F.col("id").alias(name), F.col("ext_length").alias(n))
    b = b.join(size("lead", "lead_len"), "lead").join(size("other", "other_len"), "other")
    host_leads = F.col("lead_len") >= F.col("other_len")
    b = b.withColumn("host", F.when(host_leads, F.col("lead")).otherwise(F.col("other"))).withColumn("core", F.when(host_leads, F.col("other")).otherwise(F.col("lead")))
    b = b.withColumn("host_len", F.greatest("lead_len", "other_len")).withColumn("core_len", F.least("lead_len", "other_len")).where(F.col("host_len") / F.col("core_len") >= min_ratio)
    straight = F.col("lead") == F.col("core")  # every block keeps the first block's naming, also those of the reverse direction
    side = lambda a, z: F.when(straight, F.col(a)).otherwise(F.col(z))
    return b.select("host", "core", "host_len", "core_len", side("qs", "ts").alias("core_start"), side("qe", "te").alias("core_end"), side("ts", "qs").alias("host_start"), side("te", "qe").alias("host_end"), "matches", "aligned", "ordinal")


def insertion_gaps(blocks: DataFrame, keys: list[str], order: list[str], least: int = 50) -> DataFrame:
    """Gaps between neighbouring blocks that are longer on the host than on the core by at least `least`."""
    w = Window.partitionBy(*keys).orderBy(*order)
    g = blocks.select(*keys, *order, F.lag("core_end").over(w).alias("core_position"), F.lag("host_end").over(w).alias("insertion_start"), F.col("host_start").alias("insertion_end"), F.col("core_start").alias("next_core"))
    size = (F.col("insertion_end") - F.col("insertion_start")) - F.greatest(F.col("next_core") - F.col("core_position"), F.lit(0))
    return g.withColumn("insertion_size", size).where(F.col("insertion_size") >= least).drop("next_core")


def collinear(blocks: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Whether host starts never fall in core order, for each key; strand is ignored."""
    w = Window.partitionBy(*keys).orderBy(*order)
    step = blocks.select(*keys, "host_start", F.lag("host_start").over(w).alias("before"))
    return step.groupBy(*keys).agg(F.bool_and(F.coalesce(F.col("host_start") >= F.col("before"), F.lit(True))).alias("is_collinear"), F.count(F.lit(1)).alias("n_blocks"))


def nesting_events(blocks: DataFrame, sequences: DataFrame | None = None, least: int = 50) -> DataFrame:
    """One row for each host and core with insertions: block statistics and the insertions, with their sequence if sequences (id, seq) is given."""
    keys, order = ["host", "core"], ["core_start", "ordinal"]
    w = Window.partitionBy(*keys).orderBy(*order)
    # all that a pair needs comes from one pass over its blocks: they are shuffled once
    b = blocks.where("host IS NOT NULL AND core IS NOT NULL").select("*", (F.col("host_start") < F.lag("host_start").over(w)).alias("back"), *[F.lag(c).over(w).alias(f"{c}_before") for c in ("core_end", "host_end")])
    size = (F.col("host_start") - F.col("host_end_before")) - F.greatest(F.col("core_start") - F.col("core_end_before"), F.lit(0))
    gap = F.struct(F.col("host_end_before").alias("insertion_start"), F.col("host_start").alias("insertion_end"), F.col("core_end_before").alias("core_position"), size.alias("insertion_size"))
    out = b.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(size >= least, gap))).alias("insertions"), F.bool_or(F.coalesce("back", F.lit(False))).alias("back"),
        F.count(F.lit(1)).alias("n_aligned_blocks"), F.sum(F.col("core_end") - F.col("core_start")).alias("total_aligned_bp"),
        F.round(F.sum(F.col("core_end") - F.col("core_start")) / F.max("core_len"), 4).alias("alignment_coverage"), F.round(F.try_divide(F.sum("matches"), F.sum("aligned")), 4).alias("mean_identity"),
    ).where(~F.col("back") & (F.size("insertions") > 0)).drop("back")
    if sequences is not None:
        cut = F.expr("transform(insertions, i -> named_struct('insertion_start', i.insertion_start, 'insertion_end', i.insertion_end, 'core_position', i.core_position, 'insertion_size', i.insertion_size, 'inserted_sequence', substring(seq, cast(i.insertion_start + 1 as int), cast(greatest(i.insertion_end - i.insertion_start, 0) as int))))")
        out = out.join(sequences.select(F.col("id").alias("host"), "seq"), "host", "left").withColumn("insertions", cut).drop("seq")
    return out.withColumn("n_insertions", F.size("insertions")).withColumn("total_insertion_bp", F.aggregate("insertions", F.lit(0).cast("long"), lambda s, i: s + i["insertion_size"]))
