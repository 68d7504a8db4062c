"""Element records: filters, reads, flanks and evidence put together, references, status tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociq.functions.sequence import entropy, genus
from lociq.operators.orfs import attach_proteins, coding_fractions, noncoding_regions
from lociq.operators.ranking import first_by

# filters


def consensus_state(seq: Column, least_length: int = 200, least_bits: float = 1.7) -> Column:
    """`kept`, or why a consensus is skipped: empty (also null and `NA`), short, low_complexity; the first reason counts."""
    empty = seq.isNull() | (seq == "") | (seq == "NA")
    return F.when(empty, "empty").when(F.length(seq) < least_length, "short").when(F.round(entropy(seq), 9) < least_bits, "low_complexity").otherwise("kept")


def formatter_state(n_total: Column, seq: Column, n_tail_head: Column, require_tail_head: bool = True, least_bits: float = 1.7) -> Column:
    """`kept`, or why a summary row gives no record: no_reads, low_complexity, no_tail_head."""
    poor = seq.isNull() | (seq == "") | (F.round(entropy(seq), 9) < least_bits)
    state = F.when(F.coalesce(n_total, F.lit(0)) == 0, "no_reads").when(poor, "low_complexity")
    if require_tail_head:
        state = state.when(F.coalesce(n_tail_head, F.lit(0)) == 0, "no_tail_head")
    return state.otherwise("kept")


def observed(df: DataFrame, state: Column, states: list[str]) -> tuple[DataFrame, Observation]:
    """(rows whose state is `kept`, counts of all rows by state): the counts come with the pass that uses the rows, as `observation.get` after it."""
    observation = Observation()
    counted = df.withColumn("state_", state).observe(observation, *[F.count_if(F.col("state_") == s).alias(s) for s in ("kept", *states)])
    return counted.where("state_ = 'kept'").drop("state_"), observation


def state_counts(df: DataFrame, state: str = "state") -> DataFrame:
    return df.groupBy(state).agg(F.count(F.lit(1)).alias("n"))


def usable_insertions(calls: DataFrame, contigs: DataFrame, least_size: int = 500, least_bits: float = 1.5, least_reads: int = 3) -> DataFrame:
    """Calls with a sequence: their own, or for symbolic calls with enough reads an assembled contig that is long and complex enough. Others go.

    calls: uuid, sequence (empty if symbolic), n_reads. contigs: uuid, contig, one row for each uuid.
    """
    c = F.col("contig")
    fits = (F.col("sequence") == "") & (F.col("n_reads") >= least_reads) & (F.length(c) >= least_size) & (F.round(entropy(c), 9) >= least_bits)
    found = calls.withColumn("sequence", F.coalesce("sequence", F.lit(""))).join(contigs.select("uuid", "contig"), "uuid", "left")
    return found.withColumn("assembled", F.coalesce(fits, F.lit(False))).withColumn("sequence", F.when(F.col("assembled"), c).otherwise(F.col("sequence"))).where("sequence <> ''").drop("contig")


def plottable_splits(pairs: DataFrame, order: list, longest: int = 10_000, first: int = 1000) -> DataFrame:
    """The first `first` split pairs, in a total order, whose insertion is at most `longest` (a report's limit is its feature)."""
    return pairs.where(F.col("insertion_length") <= longest).orderBy(*order).limit(first)


# reads and records


def reads_by_element(alignments: DataFrame, elements: DataFrame) -> DataFrame:
    """is_id, read_id, seq, qual: the first primary mapped alignment of each read to each element asked for, by file and place.

    alignments: reference_name (`{is_id}__...`), query_name, seq, qual, flag, ordinal. Reads without a sequence go; a missing quality is Q40.
    """
    primary = F.col("flag").bitwiseAND(0x4 | 0x100 | 0x800) == 0
    rows = alignments.where(primary & F.col("reference_name").contains("__") & (F.coalesce(F.length("seq"), F.lit(0)) > 0) & (F.col("seq") != "*"))
    rows = rows.withColumn("is_id", F.substring_index("reference_name", "__", 1)).join(elements.select("is_id").distinct(), "is_id", "left_semi")
    one = first_by(rows.select("is_id", F.col("query_name").alias("read_id"), "seq", "qual", "ordinal"), ["is_id", "read_id"], ["ordinal"])
    return one.withColumn("qual", F.when(F.col("qual").isNull() | (F.col("qual") == "*"), F.repeat(F.lit("I"), F.length("seq"))).otherwise(F.col("qual")))


def longest_reads(reads: DataFrame) -> DataFrame:
    """The first longest read of each element."""
    return first_by(reads, ["is_id"], [F.desc(F.length("seq")), "ordinal"])


def element_records(summary: DataFrame, places: DataFrame) -> DataFrame:
    """One nested record for each summary row that passes the formatter's filter and has a place on a contig.

    summary: uuid, chrom, start, end, n_* counts, example_th_read. places: uuid, sample_id, sequence, upstream, downstream, assembly_method.
    """
    piece = lambda c: F.struct(F.col(c).alias("sequence"), F.length(c).alias("length"))
    r = summary.join(places, "uuid")
    return r.select(
        F.col("uuid").alias("is_id"), "sample_id", F.lit("").alias("organism"),
        F.struct(F.col("sequence"), F.length("sequence").alias("length"), F.col("chrom").alias("contig"), "start", "end", F.lit("+").alias("strand")).alias("is_element"),
        piece("upstream").alias("flanking_upstream"), piece("downstream").alias("flanking_downstream"),
        F.struct(F.col("chrom").alias("contig"), F.col("start").alias("pos_5p"), F.col("end").alias("pos_3p")).alias("insertion_site"),
        F.struct("n_tail_head_reads", "n_genome_head_reads", "n_tail_genome_reads", F.coalesce("example_th_read", F.lit("")).alias("example_th_read")).alias("circle_evidence"),
        "assembly_method",
    )


def attach_orfs(elements: DataFrame, orfs: DataFrame, proteins: DataFrame) -> DataFrame:
    """elements (is_id, seq_len) with orf_annotation: num_orfs, coding_fraction, ORFs with their protein by start, and noncoding regions.

    An element without a sequence (seq_len null or 0) has a null annotation.
    """
    some = elements.where("seq_len > 0")
    mine = orfs.join(some.select("is_id"), "is_id", "left_semi")
    orf = F.struct(F.col("orf_start").alias("start"), F.col("orf_end").alias("end"), "strand", (F.col("orf_end") - F.col("orf_start") + 1).alias("length_nt"), "protein_sequence")
    lists = attach_proteins(mine, proteins).groupBy("is_id").agg(F.array_sort(F.collect_list(orf)).alias("orfs"))
    gap = F.struct("start", "end", "length", "type")
    gaps = noncoding_regions(mine, some).groupBy("is_id").agg(F.array_sort(F.collect_list(gap)).alias("noncoding_regions"))
    known = coding_fractions(mine, some).join(lists, "is_id", "left").join(gaps, "is_id", "left")
    note = F.struct("num_orfs", "coding_fraction", F.coalesce("orfs", F.array()).alias("orfs"), F.coalesce("noncoding_regions", F.array()).alias("noncoding_regions"))
    return elements.join(known.select("is_id", note.alias("orf_annotation")), "is_id", "left")


def element_evidence(elements: DataFrame, evidence: DataFrame, longest: DataFrame, domains: DataFrame) -> DataFrame:
    """Every element with its read count, longest ORF and number of domains; 0 on a miss. The right sides have one row for each is_id."""
    r = elements.select("is_id")
    for side, column in ((evidence, "n_th_reads"), (longest, "longest_nt"), (domains, "n_domains")):
        r = r.join(side.select("is_id", column), "is_id", "left").withColumn(column, F.coalesce(column, F.lit(0)))
    return r


def distinct_calls(calls: DataFrame) -> DataFrame:
    """One call for each element, circle start and end: the one with most reads, then the first by ordinal."""
    return first_by(calls, ["is_id", "circle_start", "circle_end"], [F.desc("n_supporting_reads"), "ordinal"])


# references


def choose_references(organisms: DataFrame, overrides: DataFrame, assemblies: DataFrame) -> DataFrame:
    """organism, accession, tier: an override, else the best assembly of the name (reference assemblies first), else of its genus, else null.

    overrides: organism, accession. assemblies: taxon, accession, level, is_reference. Levels and RefSeq decide as in `pick_assembly`.
    """
    levels = ("Complete Genome", "Chromosome", "Scaffold", "Contig")
    rank = F.coalesce(*[F.when(F.col("level") == x, F.lit(k)) for k, x in enumerate(levels)], F.lit(len(levels)))
    best = first_by(assemblies, ["taxon"], [F.desc("is_reference"), rank, ~F.col("accession").startswith("GCF_"), "accession"])
    of = lambda name: best.select(F.col("taxon").alias(name), F.col("accession").alias(f"{name}_accession"))
    o = organisms.select("organism").distinct().withColumn("exact", F.col("organism")).withColumn("genus", genus(F.col("organism")))
    o = o.join(overrides.select("organism", F.col("accession").alias("override_accession")), "organism", "left").join(of("exact"), "exact", "left").join(of("genus"), "genus", "left")
    tiers = ("override", "exact", "genus")
    tier = F.coalesce(*[F.when(F.col(f"{t}_accession").isNotNull(), F.lit(t)) for t in tiers], F.lit("none"))
    return o.select("organism", F.coalesce(*[f"{t}_accession" for t in tiers]).alias("accession"), tier.alias("tier"))


def sample_references(status: DataFrame, files: DataFrame) -> DataFrame:
    """sample_id, reference of the samples with status ok whose reference file exists; of repeated samples the last row (ordinal) stays."""
    ok = status.where("status = 'ok' AND reference <> ''").join(files.select(F.col("path").alias("reference")).distinct(), "reference", "left_semi")
    return first_by(ok, ["sample_id"], [F.desc("ordinal")]).select("sample_id", "reference")


# status tables


def metadata_of_status(status: DataFrame, headers: DataFrame) -> DataFrame:
    """srr_accession, organism, reference of every status row; the organism comes from the reference's header, else from its folder's name."""
    folder = F.element_at(F.split("reference", "/"), -2)
    return status.join(headers.select("reference", "organism"), "reference", "left").select(F.col("sample_id").alias("srr_accession"), F.coalesce("organism", folder).alias("organism"), "reference")


def discovered(units: DataFrame, files: DataFrame, folder: str, suffix: str) -> DataFrame:
    """sample_id, path: the file `{folder}/{sample_id}/{sample_id}{suffix}` of each unit, null if it does not exist."""
    path = F.concat(F.lit(f"{folder}/"), F.col("sample_id"), F.lit("/"), F.col("sample_id"), F.lit(suffix))
    there = files.select("path").distinct().withColumn("found", F.col("path"))
    return units.select("sample_id", path.alias("path")).join(there, "path", "left").select("sample_id", F.col("found").alias("path"))


def status_table(units: DataFrame, outputs: DataFrame, columns: list[str]) -> DataFrame:
    """units with status `ok` where outputs has them, else `failed`, and the outputs' columns (null on a miss), in a fixed order."""
    o = outputs.select("sample_id", *columns, F.lit("ok").alias("status"))
    return units.select("sample_id").join(o, "sample_id", "left").select("sample_id", F.coalesce("status", F.lit("failed")).alias("status"), *columns)


def table_rows(lines: DataFrame) -> DataFrame:
    """file, n_rows: lines (file, value) that are not blank, less the header; at least 0."""
    return lines.groupBy("file").agg(F.greatest(F.count_if(F.trim("value") != "") - 1, F.lit(0)).alias("n_rows"))


def missing_novelty(folders: DataFrame) -> DataFrame:
    """Tags of `system_clustering_{tag}` folders without a `novelty_{tag}` folder."""
    tags = lambda prefix: folders.where(F.col("name").startswith(prefix)).select(F.substr("name", F.lit(len(prefix) + 1)).alias("tag"))
    return tags("system_clustering_").subtract(tags("novelty_"))


def reused_or_computed(units: DataFrame, outputs: DataFrame, keys: list[str], value: str, compute: Column) -> DataFrame:
    """Every unit with its value: read from outputs where it exists there, computed only for the other units."""
    have = units.join(outputs.select(*keys, value), keys)
    rest = units.join(outputs.select(*keys).distinct(), keys, "left_anti").withColumn(value, compute)
    return have.select(*units.columns, value, F.lit(True).alias("reused")).unionByName(rest.select(*units.columns, value, F.lit(False).alias("reused")))


def ordered_members(labels: DataFrame, orfs: DataFrame) -> DataFrame:
    """cluster_id (from 0, largest first, then smallest member), size, ord (from 0), member, no_orfs of labelled nodes (node, community).

    no_orfs marks clusters of one member without an ORF. Members are rows, so no cluster is held in one array.
    """
    from lociq.operators.ranking import global_row_number

    sizes = labels.groupBy("community").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("least"))
    sizes = global_row_number(sizes, [F.desc("size"), F.col("least")], "k").select("community", "size", (F.col("k") - 1).alias("cluster_id"))
    coded = orfs.select(F.col("is_id").alias("node")).distinct().withColumn("has_orf", F.lit(True))
    rows = labels.join(sizes, "community").join(coded, "node", "left")
    ord_ = F.row_number().over(Window.partitionBy("cluster_id").orderBy("node")) - 1
    return rows.select("cluster_id", "size", ord_.cast("long").alias("ord"), F.col("node").alias("member"), ((F.col("size") == 1) & F.col("has_orf").isNull()).alias("no_orfs"))
