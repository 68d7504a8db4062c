"""Homology hits: coverage, best hits, annotation, cluster novelty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociq.operators.ranking import most_common, ordered_distinct

WEIGHTS = (0.5, 0.3, 0.2)
PIDENT_FLOOR, PIDENT_CEILING = 50.0, 95.0
NOVEL, DIVERGENT = 0.7, 0.4


def with_coverage(hits: DataFrame) -> DataFrame:
    """query_coverage from 1-based inclusive query coordinates."""
    return hits.withColumn("query_coverage", (F.abs(F.col("qend") - F.col("qstart")) + 1) / F.col("qlen"))


def ranked_hits(hits: DataFrame, least: float = 0.3) -> DataFrame:
    """Hits with enough coverage and their rank by bit score; equal scores keep their order."""
    w = Window.partitionBy("qseqid").orderBy(F.desc("bitscore"), "ordinal", "sseqid", "qstart")
    return with_coverage(hits).where(F.col("query_coverage") >= least).withColumn("rank", F.row_number().over(w))


def annotate(elements: DataFrame, ranked: DataFrame) -> DataFrame:
    """Best hit, all families and names in rank order, for every element (is_id); nulls and empty lists without hits.

    Family is the hit's group unless that is `unknown`. ranked needs qseqid, rank, hit_name, hit_group, hit_family.
    """
    family = F.when(F.col("hit_group") != "unknown", F.col("hit_group")).otherwise(F.col("hit_family"))
    r = ranked.withColumn("family", family)
    best = F.min_by(F.struct("hit_name", "family", "hit_group", "pident", "query_coverage", "bitscore"), "rank").alias("best")
    lists = r.groupBy("qseqid").agg(best, ordered_distinct("rank", "family").alias("all_hit_families"), ordered_distinct("rank", "hit_name").alias("all_hit_names"), F.count(F.lit(1)).alias("n_hits"))
    none = F.array().cast("array<string>")
    return elements.join(lists, elements["is_id"] == lists["qseqid"], "left").select(
        "is_id", F.col("best.hit_name").alias("best_hit_name"), F.col("best.family").alias("best_hit_family"), F.col("best.hit_group").alias("best_hit_group"), F.col("best.pident").alias("pident"), F.col("best.query_coverage").alias("query_coverage"), F.col("best.bitscore").alias("bitscore"),
        F.coalesce("all_hit_families", none).alias("all_hit_families"), F.coalesce("all_hit_names", none).alias("all_hit_names"), (F.size(F.coalesce("all_hit_families", none)) > 1).alias("is_multi_family"), F.coalesce("n_hits", F.lit(0)).alias("n_hits"),
    )


def cluster_stats(members: DataFrame, annotation: DataFrame) -> DataFrame:
    """Counts, identities and distinct families and names of each cluster's annotated members; members has cluster_id, is_id, ordinal."""
    m = members.join(annotation, "is_id")
    s = m.groupBy("cluster_id").agg(
        F.count_if(F.col("best_hit_name").isNotNull()).alias("n_with_match"), F.count_if(F.col("best_hit_name").isNull()).alias("n_without_match"),
        F.coalesce(F.avg("pident"), F.lit(0.0)).alias("mean_pident"), F.coalesce(F.min("pident"), F.lit(0.0)).alias("min_pident"),
        F.size(F.array_distinct(F.flatten(F.collect_list("all_hit_families")))).alias("n_distinct_families"), F.size(F.array_distinct(F.flatten(F.collect_list("all_hit_names")))).alias("n_distinct_names"),
    )
    sizes = members.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("cluster_size"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_with_match", "n_without_match", "n_distinct_families", "n_distinct_names")]
    return sizes.join(s, "cluster_id", "left").select("cluster_id", "cluster_size", *zero, F.coalesce("mean_pident", F.lit(0.0)).alias("mean_pident"), F.coalesce("min_pident", F.lit(0.0)).alias("min_pident"))


def dominant(members: DataFrame, annotation: DataFrame) -> DataFrame:
    """Most common best family and name of each cluster, first met on ties; empty strings without matches."""
    m = members.join(annotation, "is_id")
    fam, name = most_common(m, ["cluster_id"], "best_hit_family", "ordinal", "dominant_family"), most_common(m, ["cluster_id"], "best_hit_name", "ordinal", "dominant_name")
    out = members.select("cluster_id").distinct().join(fam, "cluster_id", "left").join(name, "cluster_id", "left")
    return out.select("cluster_id", F.coalesce("dominant_family", F.lit("")).alias("dominant_family"), F.coalesce("dominant_name", F.lit("")).alias("dominant_name"))


def divergence() -> Column:
    n, m = F.col("n_with_match"), F.col("n_with_match") + F.col("n_without_match")
    far = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (PIDENT_CEILING - F.col("mean_pident")) / (PIDENT_CEILING - PIDENT_FLOOR)))
    return F.when(n == 0, F.lit(1.0)).otherwise(0.5 * F.try_divide(F.col("n_without_match"), m) + 0.5 * far)


def diversity() -> Column:
    part = lambda c: F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.try_divide(F.col(c) - 1, F.col("cluster_size") - 1)))
    return F.when(F.col("cluster_size") <= 1, F.lit(0.0)).otherwise(0.4 * part("n_l1_groups") + 0.6 * part("n_l2_groups"))


def mosaic() -> Column:
    f, n = F.col("n_distinct_families"), F.col("n_distinct_names")
    return F.when((f == 0) & (n == 0), F.lit(0.5)).when(f > 1, F.lit(1.0)).when(n > 1, F.least(F.lit(0.7), 0.3 + 0.1 * (n - 1))).otherwise(0.0)


def novelty(stats: DataFrame) -> DataFrame:
    """Scores of clusters with n_l1_groups and n_l2_groups; the class goes by the rounded score."""
    s = stats.withColumn("divergence", divergence()).withColumn("diversity", diversity()).withColumn("mosaic", mosaic())
    score = F.round(WEIGHTS[0] * F.col("divergence") + WEIGHTS[1] * F.col("diversity") + WEIGHTS[2] * F.col("mosaic"), 4)
    s = s.withColumn("novelty_score", score)
    kind = F.when(F.col("novelty_score") >= NOVEL, "novel").when(F.col("novelty_score") >= DIVERGENT, "divergent").otherwise("known")
    return s.select("cluster_id", "cluster_size", *[F.round(c, 4).alias(f"{c}_score") for c in ("divergence", "diversity", "mosaic")], "novelty_score", kind.alias("novelty_class"))


def circle_flags(members: DataFrame, evidence: DataFrame) -> DataFrame:
    """Whether any member of a cluster has tail-head reads."""
    e = members.join(evidence.select("is_id", "n_tail_head_reads"), "is_id", "left")
    return e.groupBy("cluster_id").agg(F.coalesce(F.bool_or(F.col("n_tail_head_reads") > 0), F.lit(False)).alias("has_circle_evidence"))


def split_evidence(guided: DataFrame, annotated: DataFrame, partial: DataFrame) -> DataFrame:
    """is_id, circle_type: guided records are full (tail-head reads), partial or none; annotated ones not seen there are partial or none only."""
    p = partial.select("is_id").distinct().withColumn("p", F.lit(True))
    first = guided.select("is_id", "n_tail_head_reads", F.lit(0).alias("turn"))
    second = annotated.select("is_id").join(guided.select("is_id"), "is_id", "left_anti").select("is_id", F.lit(0).alias("n_tail_head_reads"), F.lit(1).alias("turn")).distinct()
    both = first.unionByName(second).join(p, "is_id", "left")
    kind = F.when((F.col("turn") == 0) & (F.col("n_tail_head_reads") > 0), "full").when(F.col("p"), "partial").otherwise("none")
    return both.select("is_id", kind.alias("circle_type"))


def _split_pairs(h: DataFrame, keys: list[str], total: float, gap: tuple[int, int]) -> DataFrame:
    """p, q, insertion_length of hits (struct h with rs, re, cov) of the same keys where q begins within `gap` behind p's end and both cover enough.

    Hits are dealt into bins by where they begin, as wide as the largest gap; a hit looks for partners in the two bins that its window touches.
    So hits further apart on the contig never meet, however many a query has there.
    """
    low, high = gap
    wide = max(high - low + 1, 1)
    q = h.select(*keys, F.col("h").alias("q"), F.floor(F.col("h.rs") / wide).alias("bin_"))
    p = h.select(*keys, F.col("h").alias("p"), F.explode(F.expr(f"sequence(cast(floor((h.re + {low}) / {wide}) AS bigint), cast(floor((h.re + {high}) / {wide}) AS bigint))")).alias("bin_"))
    met = p.join(q, [*keys, "bin_"]).withColumn("insertion_length", F.col("q.rs") - F.col("p.re")).where(F.col("insertion_length").between(low, high) & (F.col("p.cov") + F.col("q.cov") >= total))
    first = (F.col("p.rs") < F.col("q.rs")) | ((F.col("p.rs") == F.col("q.rs")) & (F.col("p") < F.col("q")))
    return met.where(first).select(*keys, "p", "q", "insertion_length")


def split_pairs(hits: DataFrame, pident: float = 80.0, part: float = 0.15, total: float = 0.7, gap: tuple[int, int] = (50, 50_000), overlap: int = 50) -> DataFrame:
    """Pairs of hits of one query on one contig that together cover it, with an insertion between them on the contig."""
    h = with_coverage(hits.where(F.col("pident") >= pident)).withColumn("cov", (F.col("qend") - F.col("qstart") + 1) / F.col("qlen")).where(F.col("cov") >= part)
    h = h.select("qseqid", "sseqid", F.struct("ordinal", "qstart", "qend", F.least("sstart", "send").alias("rs"), F.greatest("sstart", "send").alias("re"), "pident", "cov").alias("h"))
    meet = F.greatest(F.lit(0), F.least("p.qend", "q.qend") - F.greatest("p.qstart", "q.qstart") + 1)
    pairs = _split_pairs(h, ["qseqid", "sseqid"], total, gap).where(meet <= overlap)
    return pairs.select(
        "qseqid", "sseqid", F.col("p.ordinal").alias("ordinal_1"), F.col("q.ordinal").alias("ordinal_2"), F.col("p.qstart").alias("query_start_1"), F.col("p.qend").alias("query_end_1"), F.col("q.qstart").alias("query_start_2"), F.col("q.qend").alias("query_end_2"),
        F.col("p.re").alias("insertion_start"), F.col("q.rs").alias("insertion_end"), "insertion_length", (F.col("p.cov") + F.col("q.cov")).alias("query_coverage"),
    )


def split_alignments(alignments: DataFrame, part: float = 0.15, total: float = 0.7, gap: tuple[int, int] = (50, 50_000), mapq: int = 20) -> DataFrame:
    """The same for alignments with half-open coordinates and mapping qualities, without a rule for overlap on the query."""
    a = alignments.withColumn("cov", (F.col("query_end") - F.col("query_start")) / F.col("query_length")).where((F.col("mapq") >= mapq) & (F.col("cov") >= part))
    a = a.select("query_name", "contig", F.struct("ordinal", "query_start", "query_end", F.col("ref_start").alias("rs"), F.col("ref_end").alias("re"), "mapq", "cov").alias("h"))
    pairs = _split_pairs(a, ["query_name", "contig"], total, gap)
    return pairs.select("query_name", "contig", F.col("p.re").alias("insertion_start"), F.col("q.rs").alias("insertion_end"), "insertion_length", (F.col("p.cov") + F.col("q.cov")).alias("query_coverage"), F.col("p.mapq").alias("mapq_1"), F.col("q.mapq").alias("mapq_2"))


def query_places(alignments: DataFrame) -> DataFrame:
    """Mapped alignments (as read_sam and read_bam give them) with what split_alignments takes: contig, query_start (the soft clip before the aligned
    letters, in the stored direction), query_end, query_length (with clips of both kinds) and an ordinal."""
    n = lambda pattern: F.expr(f"aggregate(transform(regexp_extract_all(cigar, '{pattern}', 1), x -> cast(x AS bigint)), 0L, (s, n) -> s + n)")
    rows = alignments.where(F.col("flag").bitwiseAND(4) == 0).withColumns({"contig": F.col("reference_name"), "query_start": n("^(?:[0-9]+H)?([0-9]+)S"), "inside_": n("([0-9]+)[MI=X]"), "query_length": n("([0-9]+)[MI=XSH]")})
    rows = rows.withColumn("query_end", F.col("query_start") + F.col("inside_")).drop("inside_")
    return rows.withColumn("ordinal", F.xxhash64("contig", "ref_start", "query_start", "flag", "cigar"))


def best_splits(pairs: DataFrame) -> DataFrame:
    """The pair of the best coverage for each query and contig."""
    w = Window.partitionBy("qseqid", "sseqid").orderBy(F.desc("query_coverage"), "insertion_start", "insertion_end", "ordinal_1", "ordinal_2")
    return pairs.withColumn("k", F.row_number().over(w)).where("k = 1").drop("k")
