"""Binary alignment files: round trips, regions by the index, failed attempts."""

import re
import struct
import zlib

import numpy as np
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from lociq.sources import bam, readers

REFERENCES = [("chr1", 3_000_000), ("chr2", 100_000), ("empty", 10)]
ALIGNED = "query_name string, flag int, reference_name string, ref_start bigint, mapq int, cigar string, seq string, qual string"


def alignments(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        size = int(rng.integers(1, 400))
        cigar = f"{size}M" if k % 3 else f"5S{size}M{int(rng.integers(1, 30_000))}D7=2I"
        letters = "".join(rng.choice(list("ACGTN"), size + (0 if k % 3 else 14)))
        ref = "chr1" if k % 4 else "chr2"
        rows.append((f"r{k}", 16 * (k % 2), ref, int(rng.integers(0, 2_900_000 if ref == "chr1" else 60_000)), int(rng.integers(0, 61)), cigar, letters, "*" if k % 5 == 0 else "".join(chr(33 + int(x)) for x in rng.integers(0, 60, len(letters)))))
    return rows + [("u1", 4, "*", -1, 0, "*", "ACG", "III"), ("u2", 4, "*", -1, 0, "*", "*", "*"), ("odd", 0, "chr1", 5, 1, "1M", "A", "I"), ("r0", 0, "chr1", 5, 1, "1M", "A", "I")]


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    rows = alignments()
    path = str(tmp_path_factory.mktemp("bam") / "out")
    bam.write_bam(spark.createDataFrame(rows, ALIGNED).repartition(3), path, REFERENCES)
    return rows, path


def key(rows):
    return sorted((tuple(r)[:8] for r in rows), key=repr)


def test_round_trip(spark, written):
    rows, path = written
    got = bam.read_bam(spark, path)
    assert key(got.collect()) == key(rows)
    sam = spark.createDataFrame([("\t".join(map(str, (n, f, r, p + 1, q, c, "*", 0, 0, s, u))),) for n, f, r, p, q, c, s, u in rows], "value string")
    text = path + "-sam"
    sam.write.text(text)
    same = readers.read_sam(spark, text).where("cigar <> '*'").select("query_name", "reference_name", "ref_start", F.col("ref_end").cast("long"), "is_reverse")
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, got.where("cigar <> '*'").select("query_name", "reference_name", "ref_start", "ref_end", "is_reverse").collect()))


def test_regions_read_few_blocks(spark, written):
    rows, path = written
    whole = bam.BamReader({"path": path})
    n = sum(b.num_rows for p in whole.partitions() for b in whole.read(p))
    assert n == len(rows) and whole.blocks_read > 12
    end = lambda r: r[3] + sum(int(x[:-1]) for x in re.findall(r"\d+[MD=]", r[5]))
    for reference, start, stop in [("chr1", 1_000_000, 1_010_000), ("chr1", 0, 50), ("chr2", 30_000, 90_000), ("chr1", 2_999_000, 3_000_000), ("empty", 0, 10), ("none", 0, 10), ("chr1", 5, 6)]:
        some = bam.BamReader({"path": path, "reference": reference, "start": str(start), "end": str(stop)})
        got = [tuple(r.values()) for p in some.partitions() for b in some.read(p) for r in b.to_pylist()]
        assert key(got) == key(r for r in rows if r[2] == reference and r[3] < stop and end(r) > start)
        assert some.blocks_read < whole.blocks_read * (0.4 if stop - start < 20_000 else 1)
        assert key(bam.read_bam(spark, path, reference, start, stop).collect()) == key(got)
    assert bam.read_bam(spark, path, "chr2").count() == sum(r[2] == "chr2" for r in rows)


def test_parts_meet_without_loss(written):
    rows, path = written
    many = bam.BamReader({"path": path, "splitbytes": "1"})
    parts = many.partitions()
    assert len(parts) > 10
    assert key(tuple(r.values()) for p in parts for b in many.read(p) for r in b.to_pylist()) == key(rows)


def test_a_file_without_index_and_a_broken_one(tmp_path):
    path = str(tmp_path / "x.bam")
    with fs.LocalFileSystem().open_output_stream(path, compression=None) as sink:
        file = bam.BamFile(sink, REFERENCES)
        long = "".join("1M1D" for _ in range(40_000))  # more operations than a record's own field holds
        for r in [("b", 0, "chr1", 900, 9, "10M", "A" * 10, "*"), ("a", 0, "chr1", 10, 9, "10M", "C" * 10, "*"), ("big", 0, "chr2", 1, 3, long, "G" * 40_000, "*")]:
            file.add(*r)
        file.close()
    reader = bam.BamReader({"path": path})
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [r["query_name"] for r in rows] == ["b", "a", "big"] and rows[2]["cigar"] == long and rows[2]["ref_end"] == 80_001
    one = bam.BamReader({"path": path, "reference": "chr1", "start": "0", "end": "100"})
    assert [r["query_name"] for p in one.partitions() for b in one.read(p) for r in b.to_pylist()] == ["a"]
    raw = open(path, "rb").read()
    cut = str(tmp_path / "cut.bam")
    open(cut, "wb").write(raw[: len(raw) // 2])
    broken = bam.BamReader({"path": cut})
    with pytest.raises((EOFError, ValueError, struct.error, zlib.error)):
        [b for p in broken.partitions() for b in broken.read(p)]


def test_failed_attempts_stay_unseen(spark, tmp_path):
    path = str(tmp_path / "out")
    good = spark.createDataFrame(alignments(50), ALIGNED)
    bam.write_bam(good, path, REFERENCES)
    bad = good.withColumn("mapq", F.when(F.col("query_name") == "r7", 999).otherwise(F.col("mapq")))  # does not fit its byte
    with pytest.raises(Exception):  # noqa: B017
        bam.write_bam(bad, path, REFERENCES)
    assert bam.read_bam(spark, path).count() == 54 and not (tmp_path / "out" / "_attempts").exists()


def test_bins():
    assert [bin_ for bin_ in (bam.bin_of(0, 1), bam.bin_of(16384, 16385), bam.bin_of(0, 16385), bam.bin_of(0, 1 << 29))] == [4681, 4682, 585, 0]


def test_positions_behind_the_last_bin(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [(f"r{k}", 0, "long", p, 9, "40M", "A" * 40, "*") for k, p in enumerate([5, (1 << 29) - 20, 1 << 29, 1_190_000_000, 2_000_000_000])]
    bam.write_bam(spark.createDataFrame(rows, ALIGNED), path, [("long", (1 << 31) - 1)])
    assert key(bam.read_bam(spark, path).collect()) == key(rows)
    assert [r.query_name for r in bam.read_bam(spark, path, "long", 1_190_000_039, 1_190_000_050).collect()] == ["r3"]
    with pytest.raises(ValueError, match="behind the last position"):
        bam.BamFile(open(tmp_path / "x", "wb"), [("long", 9)]).add("far", 0, "long", (1 << 31) - 10, 9, "40M", "A" * 40, "*")


def test_bam_region_with_large_keys(spark, tmp_path):
    """Places of keys above 2.1 million do not fit a file's positions."""
    from __spark_entry__ import queries

    spark.createDataFrame([(k, p, 1, 1) for k, p in enumerate([150, 899, 900, 600_000, 7_000_000])], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = queries()["bam_region"](spark, str(tmp_path)).select("query_name", "ref_start", "n").collect()
    assert sorted(map(tuple, got)) == [("r0", 150_000, 1), ("r1", 899_000, 1)]


def test_letters_and_repeated_operations(tmp_path):
    """Letters of either case and none of the format, an odd number of them, operations met twice, and a quality that does not exist."""
    path = str(tmp_path / "x.bam")
    with fs.LocalFileSystem().open_output_stream(path, compression=None) as sink:
        file = bam.BamFile(sink, REFERENCES)
        for name in ("a", "b"):
            file.add(name, 0, "chr1", 10, 9, "3S2M4D", "acG?é", "!I~JK")
        with pytest.raises(ValueError):
            file.add("c", 0, "chr1", 10, 9, "1M", "A", " ")
        file.close()
    reader = bam.BamReader({"path": path})
    rows = [tuple(r.values()) for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [r[3:9] for r in rows] == [(10, 9, "3S2M4D", "ACGNN", "!I~JK", 16)] * 2
    assert bam._cigar.cache_info().hits > 0
