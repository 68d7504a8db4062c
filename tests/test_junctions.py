"""Junction kinds on a target of two copies of 1000 bases (overlap 100, tolerance 50)."""

import pytest
from pyspark.sql import functions as F

from lociq.functions.sequence import cigar_clips
from lociq.operators import junctions
from lociq.sources import readers

CASES = [
    ("spans the junction", 800, 1200, "400M", ["tail_head"]),
    ("head at 0", 10, 510, "150S500M", ["genome_head"]),
    ("head at N", 1005, 1505, "200S500M", ["genome_head"]),
    ("tail at N", 500, 1010, "510M200S", ["tail_genome"]),
    ("tail at 2N", 1500, 1990, "490M150S", ["tail_genome"]),
    ("clip too short", 5, 505, "50S500M", []),
    ("far from a boundary", 500, 800, "200S300M", []),
    ("hard clip", 10, 510, "150H500M", ["genome_head"]),
    ("clip at N only", 960, 1200, "200S240M", ["genome_head"]),
    ("just outside the tolerance", 50, 550, "150S500M", []),
]


@pytest.fixture(scope="module")
def classified(spark):
    rows = [(k, k, 0, rs, re, c, 60) for k, (_, rs, re, c, _) in enumerate(CASES)]
    left, right = cigar_clips(F.col("cigar"))
    a = spark.createDataFrame(rows, "read_id int, seg int, ref_id int, ref_start long, ref_end long, cigar string, mapq int").withColumns({"left_clip": left, "right_clip": right})
    targets = spark.createDataFrame([(0, "is1", 1000), (1, "is2", 1000)], "ref_id int, uuid string, n int")
    return junctions.classified(a, targets), targets


def test_kinds(classified):
    found = {r.read_id: r.types for r in classified[0].collect()}
    assert [found[k] for k in range(len(CASES))] == [c[4] for c in CASES]


def test_summary_has_every_target(classified):
    rows = {r.uuid: r for r in junctions.junction_summary(*classified).collect()}
    assert (rows["is1"].n_tail_head_reads, rows["is1"].n_genome_head_reads, rows["is1"].n_tail_genome_reads, rows["is1"].n_total_mapped) == (1, 4, 2, len(CASES))
    assert rows["is2"].n_total_mapped == 0


def test_several_kinds_at_once(spark):
    a = spark.createDataFrame([(1, 1, 0, 0, 1000, 200, 200, 60)], "read_id int, seg int, ref_id int, ref_start long, ref_end long, left_clip int, right_clip int, mapq int")
    t = spark.createDataFrame([(0, "x", 500)], "ref_id int, uuid string, n int")
    assert junctions.classified(a, t).first().types == ["tail_head", "genome_head", "tail_genome"]
    assert {r.junction_type for r in junctions.junction_reads(junctions.classified(a, t)).collect()} == set(junctions.TYPES)


def test_example_read_ties_go_to_the_first(spark):
    a = spark.createDataFrame([(r, 1, 0, 100, 900, 0, 0, 60) for r in (7, 3, 5)], "read_id int, seg int, ref_id int, ref_start long, ref_end long, left_clip int, right_clip int, mapq int")
    t = spark.createDataFrame([(0, "x", 500)], "ref_id int, uuid string, n int")
    assert junctions.example_reads(junctions.classified(a, t)).first().example_read == 3


def test_unmapped_and_secondary_go(spark):
    rows = spark.createDataFrame([(f,) for f in (0, 4, 16, 256, 2048)], "flag int")
    assert sorted(r.flag for r in junctions.mapped(rows).collect()) == [0, 16, 2048]
    assert sorted(r.flag for r in junctions.mapped(rows, supplementary=False).collect()) == [0, 16]


def test_bait_and_its_headers(spark, tmp_path):
    b = junctions.bait(spark.createDataFrame([("test1", "ACGT" * 100)], "uuid string, consensus string")).first()
    assert (b.ref_name, len(b.sequence)) == ("test1__th__j400", 800)
    (tmp_path / "b.fa").write_text(">uuid1__th__j1000\nAC\n>uuid1__ic__j500_j1500__fl500\nAC\n>uuid2__len900 x\nAC\n")
    found = {(r.uuid, r.position) for r in readers.read_bait_headers(spark, str(tmp_path / "b.fa")).collect()}
    assert found == {("uuid1", 1000), ("uuid2", 900)}
