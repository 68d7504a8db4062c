import json

from pyspark.sql import functions as F

from lociq.schemas import RECORD
from lociq.sources import readers, writers


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_fasta_round_trip(spark, tmp_path):
    rows = readers.read_fasta(spark, put(tmp_path / "a.fa", ">s1 first one\nACG\nTT\n>s2\nGG\r\n>s3\n"))
    assert {(r.name, r.header, r.sequence) for r in rows.collect()} == {("s1", "s1 first one", "ACGTT"), ("s2", "s2", "GG"), ("s3", "s3", "")}
    writers.write_fasta(rows, str(tmp_path / "out"))
    again = {(r.name, r.sequence) for r in readers.read_fasta(spark, str(tmp_path / "out")).collect()}
    assert again == {("s1", "ACGTT"), ("s2", "GG"), ("s3", "")}


def test_proteins_and_gff(spark, tmp_path):
    p = readers.read_proteins(spark, put(tmp_path / "p.faa", ">seq_0_1 # 10 # 99 # 1 # ID=1\nMK\nL*\n>seq_1_2 # 5 # 40 # -1 # x\nMM\n")).collect()
    assert {(r.seq_name, r.start, r.end, r.strand, r.protein) for r in p} == {("seq_0", 10, 99, "+", "MKL"), ("seq_1", 5, 40, "-", "MM")}
    g = readers.read_gff_cds(spark, put(tmp_path / "g.gff", "##gff-version 3\nseq_0\tP\tCDS\t10\t99\t.\t+\t0\tID=1;conf=99.5;x=1\nseq_0\tP\tgene\t1\t9\t.\t+\t0\tx\n")).collect()
    assert [(r.seq_name, r.start, r.confidence, r.length_nt) for r in g] == [("seq_0", 10, 99.5, 90)]


def test_gfa_first_longest(spark, tmp_path):
    r = readers.read_gfa_longest(spark, put(tmp_path / "a.gfa", "H\tx\nS\tu1\tACG\nS\tu2\tACGT\nS\tu3\tTTTT\nL\tu1\n")).collect()
    assert [(x.name, x.sequence) for x in r] == [("u2", "ACGT")]


def test_vcf_rules(spark, tmp_path):
    seq = "ACGT" * 150
    lines = ["##x", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
    info = "SVTYPE={};SVLEN={};SUPPORT=5;RNAMES=r1,r2"
    for k, (alt, i) in enumerate([(seq, info.format("INS", 600)), ("<INS>", info.format("INS", 700)), (seq, info.format("DEL", -600)), ("A" * 600, info.format("INS", 600)), ("N]x:1]", "SVTYPE=BND;SUPPORT=9"), ("<INS>", "SVTYPE=INS;SUPPORT=9"), (seq, "SVTYPE=INS;SVLEN=600;SUPPORT=1")]):
        lines.append(f"c\t{100 + k}\ti{k}\tA\t{alt}\t60\tPASS\t{i}")
    got = {(r.start, r.svlen, r.sequence[:4]) for r in readers.insertion_calls(readers.read_vcf(spark, put(tmp_path / "v.vcf", "\n".join(lines) + "\n"))).collect()}
    assert {(100, 600, "ACGT"), (101, 700, "")} <= got and not {102, 103, 105, 106} & {g[0] for g in got}


def test_sam_paf_blast_tblout(spark, tmp_path):
    sam = "@HD\nq1\t0\tt\t11\t30\t5S10M2D3M\t*\t0\t0\tACGT\tIIII\nq1\t16\tt\t51\t30\t9M\t*\t0\t0\tAC\tII\nq2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n"
    s = readers.read_sam(spark, put(tmp_path / "s.sam", sam))
    assert {(r.query_name, r.ref_start, r.ref_end, r.is_reverse) for r in s.collect()} >= {("q1", 10, 25, False), ("q1", 50, 59, True)}
    assert [(r.query_name, r.ref_start) for r in readers.best_alignment(s).collect()] == [("q1", 10)]
    p = readers.read_paf(spark, put(tmp_path / "p.paf", "a\t100\t0\t90\t+\tb\t200\t5\t95\t88\t90\t60\ttp:A:P\tcg:Z:90=\nshort\t1\n")).collect()
    assert [(r.query, r.target_start, r.cigar) for r in p] == [("a", 5, "90=")]
    b = readers.read_blast(spark, put(tmp_path / "b.tsv", "q\tISX_1_IS3_IS150\t99.5\t50\t0\t0\t1\t50\t9\t58\t1e-9\t88\t100\t900\n")).first()
    assert (b.hit_name, b.hit_group, b.hit_family, b.query_coverage) == ("ISX_1", "IS3", "IS150", 0.5)
    t = readers.read_tblout(spark, put(tmp_path / "t.txt", "# x\na__b__10_99_+  -  D  1\na__b__10_99_+  -  D  2\nc__5_9_-  -\n"), "DEDD").collect()
    assert {(r.is_id, r.start, r.end, r.strand) for r in t} == {("a__b", 10, 99, "+"), ("c", 5, 9, "-")}
    c = readers.read_cluster_pairs(spark, put(tmp_path / "c.tsv", "r1\tm\nr2\tm\nr1\tr1\n")).collect()
    assert {(r.representative, r.member) for r in c} == {("r2", "m"), ("r1", "r1")}


def test_records_skip_bad_files_and_first_wins(spark, tmp_path):
    rec = lambda i, s: {"is_id": i, "sample_id": s, "is_element": {"sequence": "ACGTACGT", "chrom": "c"}, "circle_evidence": {"n_tail_head_reads": 2}}
    put(tmp_path / "a" / "x_guide.json", json.dumps([rec("1", "a"), rec("2", "a")]))
    put(tmp_path / "b" / "y_guide.json", json.dumps([rec("2", "b"), rec("3", "b")]))
    put(tmp_path / "c" / "z_guide.json", "{ not json")
    rows = readers.read_records(spark, f"{tmp_path}/*/*_guide.json")
    assert {(r.is_id, r.sample_id, r.sample_dir, r.contig) for r in rows.collect()} == {("1", "a", "a", "c"), ("2", "a", "a", "c"), ("3", "b", "b", "c")}
    f = writers.feature_rows(rows.where("is_id = '1'")).orderBy("ord").collect()
    assert [(x.type, x.start, x.end) for x in f] == [("mobile_element", 0, 8), ("circle", 0, 8)]
    assert "mobile_element" in writers.feature_lines(writers.feature_rows(rows)).first().value


def test_sinks(spark, tmp_path):
    empty = spark.createDataFrame([], "a string, b int")
    writers.write_tsv(empty, str(tmp_path / "e"), ["b", "a"])
    assert any(p.read_text().strip() == "b\ta" for p in (tmp_path / "e").glob("part-*"))
    d = spark.createDataFrame([("r", "ACG", None)], "n string, s string, q string")
    assert writers.fastq_lines(d, "n", "s", "q").first().value == "@r\nACG\n+\nIII"
    writers.write_records(spark.createDataFrame([("1", "full"), ("2", "none")], "is_id string, circle_type string"), str(tmp_path / "r"), ["circle_type"])
    assert {p.name for p in (tmp_path / "r").iterdir() if p.is_dir()} == {"circle_type=full", "circle_type=none"}
    inc = spark.createDataFrame([(1, "f"), (2, "f")], "is_id int, family string")
    writers.write_incidence(inc, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m" / "family")).count() == 1


def test_xml_reports_and_listing(spark, tmp_path):
    xml = '<SET><EXPERIMENT_PACKAGE><EXPERIMENT accession="SRX1"><TITLE>t</TITLE></EXPERIMENT><SAMPLE accession="SRS1"><SAMPLE_NAME><SCIENTIFIC_NAME>E. coli</SCIENTIFIC_NAME></SAMPLE_NAME></SAMPLE><RUN_SET><RUN accession="SRR1" total_bases="5"/><RUN accession="SRR2"/></RUN_SET></EXPERIMENT_PACKAGE></SET>'
    got = {(r.srr_accession, r.srx_accession, r.organism, r.total_bases) for r in readers.read_sra_xml(spark, put(tmp_path / "x.xml", xml)).collect()}
    assert got == {("SRR1", "SRX1", "E. coli", "5"), ("SRR2", "SRX1", "E. coli", "")}
    lines = [json.dumps({"reports": [{"accession": "GCF_1", "assembly_info": {"assembly_level": "Contig"}}]}), "broken", json.dumps({"accession": "GCA_2"})]
    assert {(r.accession, r.level) for r in readers.read_assembly_reports(spark, put(tmp_path / "j.jsonl", "\n".join(lines))).collect()} == {("GCF_1", "Contig"), ("GCA_2", "")}
    put(tmp_path / "l" / "s1" / "s1.fastq.gz", "x")
    put(tmp_path / "l" / "s1" / "s1.fastq", "yy")
    files = readers.list_files(spark, str(tmp_path / "l"))
    assert readers.find_by_patterns(files, [r"\.fastq$", r"\.fastq\.gz$"]).first().name == "s1.fastq"
    assert tuple(readers.folder_sizes(files).first()) == ("s1", 2, 3)


def test_tables(spark, tmp_path):
    t = readers.read_insertions(spark, put(tmp_path / "t.tsv", "UUID\tChrom\tStart\tEnd\tFamily\tSubfamily\tConsensus\tSupport\nu\tc\t1\t9\tf\ts\tACG\t\n")).first()
    assert (t.uuid, t.start, t.support) == ("u", 1, 0)
    h = spark.createDataFrame([(">NC_1 Escherichia coli strain",), ("x [Genus species] y",), ("one",)], "h string")
    assert [r[0] for r in h.select(readers.organism_of_header(F.col("h"), F.lit("dir"))).collect()] == ["Escherichia coli", "Genus species", "dir"]
    assert spark.createDataFrame([], RECORD).count() == 0
