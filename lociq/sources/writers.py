"""Sinks: TSV, JSON records, FASTA and FASTQ, sparse matrices, feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def write_tsv(df: DataFrame, path: str, columns: list[str]) -> None:
    """Named columns in their order, others left out; an empty table still has its header."""
    df.select(*columns).write.csv(path, sep="\t", header=True, quote="", emptyValue="", nullValue="", mode="overwrite")


def write_records(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """JSON lines of nested records, in folders by the given columns."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).json(path)


def write_record_arrays(df: DataFrame, path: str, by: str, order: list[str], groups: DataFrame | None = None) -> None:
    """One JSON array in a file of each folder `by=value`, a record on each line, in a total order; what read_records and other JSON readers take.

    Lines of a group stream in order from one task to its file, so an array is never held as a whole. groups (column `by`) names folders that
    get a file in any case: `[]` where they have no record. A failed task's file is never seen (the writer commits whole files).
    """
    w = Window.partitionBy(by).orderBy(*order)
    fields = [c for c in df.columns if c != by]
    lines = df.select(by, F.to_json(F.struct(*fields)).alias("json"), F.row_number().over(w).alias("k"), F.lead(F.lit(1)).over(w).alias("more"))
    lines = lines.select(by, "k", F.concat(F.when(F.col("k") == 1, "[").otherwise(""), "json", F.when(F.col("more").isNull(), "]").otherwise(",")).alias("value"))
    if groups is not None:
        empty = groups.select(by).distinct().join(df.select(by).distinct(), by, "left_anti").select(by, F.lit(1).alias("k"), F.lit("[]").alias("value"))
        lines = lines.unionByName(empty)
    lines.repartition(by).sortWithinPartitions(by, "k").select(by, "value").write.mode("overwrite").partitionBy(by).text(path)


def fasta_lines(df: DataFrame, name: str, seq: str) -> DataFrame:
    return df.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.col(seq)).alias("value"))


def fastq_lines(df: DataFrame, name: str, seq: str, quality: str) -> DataFrame:
    q = F.coalesce(F.col(quality), F.repeat(F.lit("I"), F.length(seq)))
    return df.select(F.concat(F.lit("@"), F.col(name), F.lit("\n"), F.col(seq), F.lit("\n+\n"), q).alias("value"))


def write_fasta(df: DataFrame, path: str, name: str = "name", seq: str = "sequence") -> None:
    fasta_lines(df, name, seq).write.mode("overwrite").text(path)


def write_incidence(inc: DataFrame, path: str) -> None:
    """Sparse matrix as Parquet: entries, by element and family."""
    inc.write.mode("overwrite").parquet(f"{path}/entries")
    for c in inc.columns:
        inc.select(c).distinct().write.mode("overwrite").parquet(f"{path}/{c}")


def feature_rows(records: DataFrame) -> DataFrame:
    """is_id, ord, type, start, end, strand, label of an element's features, placed behind its upstream flank: flanks, boundary, circle,
    CDS, noncoding regions, guide hits (0-based, half-open). records follows schemas.RECORD."""
    up = F.coalesce(F.length("flanking_upstream.sequence"), F.lit(0))
    n = F.length("is_element.sequence")
    down = F.coalesce(F.length("flanking_downstream.sequence"), F.lit(0))
    item = lambda o, kind, s, e, strand, label: F.struct(F.lit(o).alias("ord"), F.lit(kind).alias("type"), s.cast("long").alias("start"), e.cast("long").alias("end"), strand.alias("strand"), label.alias("label"))
    plus, zero = F.lit("+"), F.lit(0)
    fixed = F.array(
        F.when(up > 0, item(0, "flank", zero, up, plus, F.lit("upstream"))), F.when(down > 0, item(1, "flank", up + n, up + n + down, plus, F.lit("downstream"))),
        item(2, "mobile_element", up, up + n, plus, F.col("is_id")), F.when(F.col("circle_evidence.n_tail_head_reads") > 0, item(3, "circle", up, up + n, plus, F.concat(F.col("circle_evidence.n_tail_head_reads").cast("string"), F.lit(" reads")))),
    )
    cds = F.transform("orf_annotation.orfs", lambda o, k: item(4, "CDS", up + o["start"] - 1, up + o["end"], o["strand"], F.concat(F.lit("orf_"), (k + 1).cast("string"))))
    gaps = F.transform("orf_annotation.noncoding_regions", lambda r: item(5, "noncoding", up + r["start"] - 1, up + r["end"], plus, r["type"]))
    guides = F.transform("guide_hits", lambda g: item(6, "guide", up + g["noncoding_start"] - 1 + g["pos_in_noncoding"], up + g["noncoding_start"] - 1 + g["pos_in_noncoding"] + g["length"], F.when(g["orientation"] == "forward", "+").otherwise("-"), g["seq_noncoding"]))
    none = F.array().cast("array<struct<ord:int,type:string,start:bigint,end:bigint,strand:string,label:string>>")
    every = F.concat(F.array_compact(fixed), *[F.coalesce(x, none) for x in (cds, gaps, guides)])
    return records.select("is_id", F.explode(every).alias("f")).select("is_id", "f.*")


def feature_lines(features: DataFrame) -> DataFrame:
    """Feature table text: a line with the place (1-based), one with the label."""
    place = F.concat((F.col("start") + 1).cast("string"), F.lit(".."), F.col("end").cast("string"))
    place = F.when(F.col("strand") == "-", F.concat(F.lit("complement("), place, F.lit(")"))).otherwise(place)
    return features.select("is_id", "ord", "start", F.concat(F.lit("     "), F.rpad("type", 16, " "), place, F.lit('\n                     /label="'), F.col("label"), F.lit('"')).alias("value"))
