"""Open reading frames: noncoding gaps, coding fraction, domains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def noncoding_regions(orfs: DataFrame, elements: DataFrame) -> DataFrame:
    """is_id, start, end, length, type of the gaps between an element's ORFs (1-based, inclusive).

    The 3' gap begins after the ORF that starts last, even if another reaches further. An element without ORFs is one `full` gap.
    elements has is_id and seq_len; orfs has is_id, orf_start, orf_end, ordinal.
    """
    w = Window.partitionBy("is_id").orderBy("orf_start", "ordinal")
    placed = orfs.join(elements, "is_id").select("is_id", "orf_start", "orf_end", "seq_len", F.row_number().over(w).alias("k"), F.lead("orf_start").over(w).alias("next_start"))
    gap = lambda when, start, end, kind: F.when(when & (start <= end), F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"), F.lit(kind).alias("type")))
    one = F.lit(1)
    gaps = F.array_compact(F.array(
        gap(F.col("k") == 1, one, F.col("orf_start") - 1, "5_prime"),
        gap(F.col("next_start").isNotNull(), F.col("orf_end") + 1, F.col("next_start") - 1, "intergenic"),
        gap(F.col("next_start").isNull(), F.col("orf_end") + 1, F.col("seq_len"), "3_prime"),
    ))
    some = placed.select("is_id", F.explode(gaps).alias("g")).select("is_id", "g.*")
    none = elements.join(orfs.select("is_id").distinct(), "is_id", "left_anti").select("is_id", one.cast("long").alias("start"), F.col("seq_len").cast("long").alias("end"), F.lit("full").alias("type"))
    return some.unionByName(none).withColumn("length", F.col("end") - F.col("start") + 1)


def coding_fractions(orfs: DataFrame, elements: DataFrame) -> DataFrame:
    """num_orfs and the ORFs' total length over the element's, rounded to 4 places; above 1 where ORFs overlap."""
    sums = orfs.groupBy("is_id").agg(F.count(F.lit(1)).alias("num_orfs"), F.sum(F.col("orf_end") - F.col("orf_start") + 1).alias("nt"))
    return elements.join(sums, "is_id", "left").select("is_id", F.coalesce("num_orfs", F.lit(0)).alias("num_orfs"), F.round(F.coalesce("nt", F.lit(0)) / F.col("seq_len"), 4).alias("coding_fraction"))


def attach_proteins(orfs: DataFrame, proteins: DataFrame) -> DataFrame:
    """ORFs with their protein by element, place and strand; an empty string where there is none."""
    key = ["is_id", "orf_start", "orf_end", "strand"]
    return orfs.join(proteins.select(*key, "protein_sequence"), key, "left").withColumn("protein_sequence", F.coalesce("protein_sequence", F.lit("")))


def same_orf_domains(orfs: DataFrame) -> DataFrame:
    """Elements with an ORF that has both domains."""
    return orfs.where("has_dedd AND has_tnp20").select("is_id").distinct()


def adjacent_domains(orfs: DataFrame, max_gap: int = 300) -> DataFrame:
    """Elements where ORFs with one and the other domain lie at most max_gap apart (0 if they overlap)."""
    a = orfs.where("has_dedd").select("is_id", F.col("orf_start").alias("ds"), F.col("orf_end").alias("de"))
    b = orfs.where("has_tnp20").select("is_id", F.col("orf_start").alias("ts"), F.col("orf_end").alias("te"))
    near = F.greatest(F.col("ts") - F.col("de"), F.col("ds") - F.col("te"), F.lit(0)) <= max_gap
    return a.join(b, "is_id").where(near).select("is_id").distinct()


def two_domain_elements(orfs: DataFrame, max_gap: int = 300) -> DataFrame:
    """Elements with both domains, in one ORF or in ORFs near to each other."""
    return same_orf_domains(orfs).union(adjacent_domains(orfs, max_gap)).distinct()


def orf_domains(orfs: DataFrame, hits: DataFrame) -> DataFrame:
    """ORFs with the sorted distinct domains of their place (strand ignored); null where none is known."""
    names = hits.groupBy("is_id", "orf_start", "orf_end").agg(F.array_sort(F.collect_set("domain")).alias("domains"))
    return orfs.join(names, ["is_id", "orf_start", "orf_end"], "left")


def domain_map(hits: DataFrame, elements: DataFrame) -> DataFrame:
    """is_id, domains: of each element asked for that has hits a map from (start, end) to its domains, in order of `ordinal`, repeated ones each time.

    hits: is_id, orf_start, orf_end, domain, ordinal. An element's map is as large as its ORFs with domains.
    """
    asked = hits.join(elements.select("is_id").distinct(), "is_id", "left_semi")
    names = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "domain"))), lambda x: x["domain"]).alias("names")
    places = asked.groupBy("is_id", "orf_start", "orf_end").agg(names)
    entry = F.struct(F.struct("orf_start", "orf_end").alias("place"), "names")
    return places.groupBy("is_id").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("domains"))


def longest_orf(orfs: DataFrame) -> DataFrame:
    return orfs.groupBy("is_id").agg(F.max(F.col("orf_end") - F.col("orf_start") + 1).alias("longest_nt"))
