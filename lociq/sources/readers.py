"""Readers of the domain's text formats as DataFrames. Everything is parsed by Spark's own text, CSV, JSON and XML sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociq.functions.sequence import cigar_reference_length, reference_header
from lociq.operators.ranking import first_by
from lociq.schemas import BLAST6, CIRCLE_SUMMARY, CLUSTER_PAIRS, INSERTIONS, PARTIAL_CIRCLE, RECORD, RUN_METADATA
from lociq.storage import stored


def read_tsv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """A TSV file by declared columns; fields may be of any length."""
    return spark.read.csv(path, sep="\t", header=header, schema=schema, maxCharsPerColumn=-1, quote="", enforceSchema=True)


def read_insertions(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, INSERTIONS).withColumn("support", F.coalesce("support", F.lit(0)))


def read_circle_summary(spark: SparkSession, path: str) -> DataFrame:
    df = read_tsv(spark, path, CIRCLE_SUMMARY)
    return df.fillna(0, [c for c in df.columns if c.startswith("n_")]).fillna("", ["family", "subfamily", "example_th_read"])


def read_run_metadata(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, RUN_METADATA)


def _sample_of_path() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Element records of JSON array files. Files that do not parse give no rows; of a repeated is_id the first file's first row stays."""
    raw = spark.read.json(path, schema=RECORD, multiLine=True, mode="PERMISSIVE").withColumns({"file": F.col("_metadata.file_path"), "sample_dir": _sample_of_path()})
    rows = raw.where("is_id IS NOT NULL").withColumn("place", F.monotonically_increasing_id())
    rows = first_by(rows, ["is_id"], ["file", "place"])
    return rows.withColumn("contig", F.coalesce("is_element.contig", "is_element.chrom")).drop("place")


def read_records_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(element records as read_records has them; file, reason, n of what was left out), from one pass over the files.

    A file that does not parse, such as one that ends too early, gives `not JSON` and no record; records without is_id are counted by file.
    """
    bad = "corrupt_"
    raw = spark.read.json(path, schema=f"{RECORD}, {bad} string", multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord=bad)
    raw = raw.withColumns({"file": F.col("_metadata.file_path"), "sample_dir": _sample_of_path(), "place": F.monotonically_increasing_id(), bad: F.col(bad).isNotNull()})
    rows = stored(raw, "records")
    left = rows.where(f"{bad} OR is_id IS NULL").groupBy("file", F.when(F.col(bad), "not JSON").otherwise("no is_id").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    spoiled = left.where("reason = 'not JSON'").select("file")  # a row for each such file
    kept = rows.where("is_id IS NOT NULL").join(spoiled, "file", "left_anti")
    kept = first_by(kept, ["is_id"], ["file", "place"]).withColumn("contig", F.coalesce("is_element.contig", "is_element.chrom"))
    return kept.drop("place", bad), left


def read_partial_circles(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """is_id with the calls of all JSON files below path, as an ordered list."""
    raw = spark.read.json(path, schema=PARTIAL_CIRCLE, multiLine=True, mode="PERMISSIVE", recursiveFileLookup=True, pathGlobFilter=glob).where("is_id IS NOT NULL")
    call = F.struct(*[c for c in raw.columns if c not in ("is_id", "is_length")])
    return raw.groupBy("is_id").agg(F.array_sort(F.collect_list(call)).alias("calls"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """name (first token), header, sequence of each record; sequence lines are joined and white space goes."""
    raw = spark.read.text(path, lineSep=">").where(F.length(F.trim("value")) > 0)
    parts = F.split("value", "\n", 2)
    header = F.trim(F.regexp_replace(parts[0], "\r", ""))
    return raw.select(F.element_at(F.split(header, r"\s+"), 1).alias("name"), header.alias("header"), F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"\s+", "").alias("sequence"))


def read_bait_headers(spark: SparkSession, path: str) -> DataFrame:
    """ref_name, uuid, position of bait FASTA headers: `{uuid}__th__j{N}`, and the older `{uuid}__len{N}`; others are ignored."""
    rows = spark.read.text(path).where(F.col("value").startswith(">")).select(F.regexp_replace(F.element_at(F.split(F.substr("value", F.lit(2)), r"\s+"), 1), r"\s", "").alias("ref_name"))
    pattern = r"^(.*)__(?:th__j|len)(\d+)$"
    return rows.where(F.col("ref_name").rlike(pattern)).select("ref_name", F.regexp_extract("ref_name", pattern, 1).alias("uuid"), F.lit("tail_head").alias("type"), F.regexp_extract("ref_name", pattern, 2).cast("long").alias("position"))


def read_proteins(spark: SparkSession, path: str) -> DataFrame:
    """seq_name, start, end, strand, protein of protein FASTA with headers `name_k # start # end # strand # ...`."""
    f = F.split("header", " # ")
    return read_fasta(spark, path).where(F.size(f) >= 4).select(
        F.regexp_extract(f[0], r"^(.*)_\d+$", 1).alias("seq_name"), f[1].cast("long").alias("start"), f[2].cast("long").alias("end"), F.when(F.trim(f[3]) == "1", "+").otherwise("-").alias("strand"), F.regexp_replace("sequence", r"\*+$", "").alias("protein"),
    )


def read_gff_cds(spark: SparkSession, path: str) -> DataFrame:
    """CDS rows of a GFF3 file with their confidence; 1-based inclusive."""
    schema = "seq_name string, source string, type string, start bigint, end bigint, score string, strand string, phase string, attributes string"
    conf = F.regexp_extract("attributes", r"(?:^|;)conf=([0-9.]+)", 1)
    rows = spark.read.csv(path, sep="\t", comment="#", schema=schema, quote="").where("type = 'CDS'")
    return rows.select("seq_name", "start", "end", "strand", F.when(conf == "", F.lit(0.0)).otherwise(conf.cast("double")).alias("confidence"), (F.col("end") - F.col("start") + 1).alias("length_nt"))


def read_gfa_longest(spark: SparkSession, path: str) -> DataFrame:
    """file, name, sequence: the first longest segment of each GFA file."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where(F.col("value").startswith("S\t")).select(F.col("_metadata.file_path").alias("file"), f[1].alias("name"), f[2].alias("sequence"), F.monotonically_increasing_id().alias("place"))
    return rows.groupBy("file").agg(F.max_by(F.struct("name", "sequence"), F.struct(F.length("sequence"), -F.col("place"))).alias("s")).select("file", "s.*")


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """VCF rows with INFO as a map."""
    schema = "chrom string, pos bigint, id string, ref string, alt string, qual string, filter string, info string"
    return spark.read.csv(path, sep="\t", comment="#", schema=schema, quote="", mode="PERMISSIVE").withColumn("tags", F.str_to_map("info", F.lit(";"), F.lit("=")))


def insertion_calls(vcf: DataFrame, min_size: int = 500, max_size: int = 20_000, min_support: int = 3, min_entropy: float = 1.5) -> DataFrame:
    """Insertions, duplications and breakends of fitting size and support; a resolved sequence must be complex enough, a symbolic one is empty."""
    from lociq.functions.sequence import entropy

    tag = lambda k: F.try_element_at("tags", F.lit(k))
    symbolic = F.col("alt").startswith("<")
    size = F.coalesce(F.abs(tag("SVLEN").try_cast("long")), F.when(tag("SVTYPE") == "BND", F.lit(min_size)).when(~symbolic, F.length("alt") - F.length("ref")))
    v = vcf.withColumn("svtype", tag("SVTYPE")).where(F.col("svtype").isin("INS", "DUP", "BND")).withColumn("svlen", size.cast("long")).withColumn("support", F.coalesce(tag("SUPPORT").try_cast("int"), F.lit(0)))
    v = v.where(F.col("svlen").between(min_size, max_size) & (F.col("support") >= min_support)).withColumn("sequence", F.when(symbolic, F.lit("")).otherwise(F.col("alt")))
    return v.where((F.col("sequence") == "") | (entropy(F.col("sequence")) >= min_entropy)).select("chrom", F.col("pos").alias("start"), (F.col("pos") + F.col("svlen")).alias("end"), "svtype", "svlen", "support", "sequence", tag("RNAMES").alias("read_names"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of SAM text, 0-based half-open."""
    f = F.split("value", "\t")
    at = lambda k: F.get(f, F.lit(k))  # noqa: E731  short lines give null before the filter drops them
    rows = spark.read.text(path).where(~F.col("value").startswith("@")).where(F.size(f) >= 11)
    rows = rows.select(at(0).alias("query_name"), at(1).cast("int").alias("flag"), at(2).alias("reference_name"), (at(3).cast("long") - 1).alias("ref_start"), at(4).cast("int").alias("mapq"), at(5).alias("cigar"), at(9).alias("seq"), at(10).alias("qual"))
    return rows.withColumn("ref_end", F.col("ref_start") + cigar_reference_length(F.col("cigar"))).withColumn("is_reverse", F.col("flag").bitwiseAND(16) != 0)


def region(sam: DataFrame, reference: str, start: int, end: int) -> DataFrame:
    """Mapped alignments that overlap [start, end) of a reference. On Parquet sorted by reference_name and ref_start the filters reach the scan."""
    mapped = F.col("flag").bitwiseAND(4) == 0
    return sam.where((F.col("reference_name") == reference) & (F.col("ref_start") < end) & (F.col("ref_end") > start) & mapped)


def write_sorted_alignments(sam: DataFrame, path: str) -> None:
    """Alignments as Parquet in ranges of reference and start, so that a region reads few files and row groups."""
    sam.repartitionByRange("reference_name", "ref_start").sortWithinPartitions("reference_name", "ref_start").write.mode("overwrite").parquet(path)


def best_alignment(sam: DataFrame) -> DataFrame:
    """The mapped alignment of the highest mapping quality for each query, the first on ties."""
    rows = sam.where(F.col("flag").bitwiseAND(4) == 0).withColumn("place", F.monotonically_increasing_id())
    return first_by(rows, ["query_name"], [F.desc("mapq"), "place"]).drop("place")


def read_paf(spark: SparkSession, path: str) -> DataFrame:
    """PAF rows of at least 12 fields, with the `cg:Z:` tag as cigar if there is one."""
    f = F.split("value", "\t")
    at = lambda k: F.get(f, F.lit(k))
    rows = spark.read.text(path).where(F.size(f) >= 12)
    num = lambda k: at(k).cast("long")
    return rows.select(
        at(0).alias("query"), num(1).alias("query_len"), num(2).alias("query_start"), num(3).alias("query_end"), at(4).alias("strand"), at(5).alias("target"), num(6).alias("target_len"), num(7).alias("target_start"), num(8).alias("target_end"), num(9).alias("matches"), num(10).alias("block_length"),
        F.substr(F.get(F.filter(f, lambda x: x.startswith("cg:Z:")), F.lit(0)), F.lit(6)).alias("cigar"), F.monotonically_increasing_id().alias("ordinal"),
    )


def read_blast(spark: SparkSession, path: str) -> DataFrame:
    """Tabular BLAST hits with coverage and the parts of the subject's name."""
    name, group, family = reference_header(F.col("sseqid"))
    rows = read_tsv(spark, path, BLAST6, header=False)
    return rows.withColumns({"query_coverage": (F.abs(F.col("qend") - F.col("qstart")) + 1) / F.col("qlen"), "hit_name": name, "hit_group": group, "hit_family": family, "ordinal": F.monotonically_increasing_id()})


def read_tblout(spark: SparkSession, path: str, domain: str) -> DataFrame:
    """protein_id, is_id, start, end, strand, domain of HMM hits; targets are `{id}__{start}_{end}_{strand}`, the first row of a protein stays."""
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != "")).select(F.element_at(F.split("value", r"\s+"), 1).alias("protein_id"), F.monotonically_increasing_id().alias("place"))
    pattern = r"^(.*)__(\d+)_(\d+)_(.)"
    rows = first_by(rows.where(F.col("protein_id").rlike(pattern)), ["protein_id"], ["place"])
    part = lambda k: F.regexp_extract("protein_id", pattern, k)
    return rows.select("protein_id", part(1).alias("is_id"), part(2).cast("long").alias("start"), part(3).cast("long").alias("end"), part(4).alias("strand"), F.lit(domain).alias("domain"))


def read_cluster_pairs(spark: SparkSession, path: str) -> DataFrame:
    """representative, member; a member's last row stays."""
    rows = read_tsv(spark, path, CLUSTER_PAIRS, header=False).withColumn("place", F.monotonically_increasing_id())
    return first_by(rows, ["member"], [F.desc("place")]).drop("place")


def read_sra_xml(spark: SparkSession, path: str) -> DataFrame:
    """One row for each RUN of the experiment packages, with the fields of its package."""
    schema = (
        "EXPERIMENT struct<_accession:string,TITLE:string,DESIGN:struct<LIBRARY_DESCRIPTOR:struct<LIBRARY_STRATEGY:string,LIBRARY_SOURCE:string>>>, STUDY struct<_accession:string>, "
        "SAMPLE struct<_accession:string,SAMPLE_NAME:struct<SCIENTIFIC_NAME:string>>, RUN_SET struct<RUN:array<struct<_accession:string,_total_bases:string,_total_spots:string>>>"
    )
    rows = spark.read.format("xml").option("rowTag", "EXPERIMENT_PACKAGE").schema(schema).load(path).withColumn("run", F.explode("RUN_SET.RUN"))
    text = lambda c, n: F.coalesce(F.col(c), F.lit("")).alias(n)
    return rows.select(
        text("run._accession", "srr_accession"), text("EXPERIMENT._accession", "srx_accession"), text("SAMPLE._accession", "srs_accession"), text("STUDY._accession", "srp_accession"), text("SAMPLE.SAMPLE_NAME.SCIENTIFIC_NAME", "organism"),
        text("run._total_bases", "total_bases"), text("run._total_spots", "total_spots"), text("EXPERIMENT.DESIGN.LIBRARY_DESCRIPTOR.LIBRARY_STRATEGY", "library_strategy"), text("EXPERIMENT.DESIGN.LIBRARY_DESCRIPTOR.LIBRARY_SOURCE", "library_source"), text("EXPERIMENT.TITLE", "title"),
    )


def read_assembly_reports(spark: SparkSession, path: str) -> DataFrame:
    """Assemblies of JSON lines that are reports or hold a list of reports; lines that do not parse are left out."""
    one = "accession:string,assembly_info:struct<assembly_level:string>,organism:struct<organism_name:string>"
    schema = f"{one.replace(':struct', ' struct').replace('accession:', 'accession ')}, reports array<struct<{one}>>"
    rows = spark.read.json(path, schema=schema, mode="DROPMALFORMED")
    own = F.array(F.struct("accession", "assembly_info", "organism"))
    r = rows.select(F.explode(F.coalesce("reports", own)).alias("r")).where("r.accession IS NOT NULL")
    return r.select(F.col("r.accession").alias("accession"), F.coalesce("r.assembly_info.assembly_level", F.lit("")).alias("level"), F.col("r.organism.organism_name").alias("organism"))


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """path, name, folder, size of all files below path; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(path).select("path", "length")
    return files.select("path", F.substring_index("path", "/", -1).alias("name"), F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("folder"), F.col("length").alias("size"))


def find_by_patterns(files: DataFrame, patterns: list[str]) -> DataFrame:
    """For each folder the file whose name fits the earliest pattern (a regular expression), the first by name among those."""
    rank = F.coalesce(*[F.when(F.col("name").rlike(p), F.lit(k)) for k, p in enumerate(patterns)])
    return first_by(files.withColumn("rank", rank).where("rank IS NOT NULL"), ["folder"], ["rank", "name"])


def folder_sizes(files: DataFrame) -> DataFrame:
    return files.groupBy("folder").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("bytes"))


def organism_of_header(header: Column, fallback: Column) -> Column:
    """The bracketed name of a FASTA header, else the two words behind its first token, else the fallback."""
    words = F.split(F.trim(F.regexp_replace(header, r"^\S+\s*", "")), r"\s+")
    two = F.when(F.size(words) >= 2, F.concat_ws(" ", F.slice(words, 1, 2)))
    return F.coalesce(F.nullif(F.regexp_extract(header, r"\[([^\]]+)\]", 1), F.lit("")), two, fallback)
