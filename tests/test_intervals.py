"""Interval joins and split hits against brute force, and the pairs that meet."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociq.operators import hits, intervals


@pytest.mark.parametrize("hot", [200_000, 5])
def test_overlaps(spark, hot):
    """Long and short intervals, repeated rows, a crowded bin, borders of bins, empty and null intervals."""
    rng = np.random.default_rng(hot)
    width = lambda: int(rng.choice([1, 50, 20_000, 3_000_000, 1 << 34]))
    at = lambda: int(rng.choice([0, 16_383, 16_384, 131_072, 5_000_000])) + int(rng.integers(0, 3000))
    a = [(k, f"c{k % 3}", s, s + width()) for k in range(150) if (s := at()) >= 0] + [(900, "c0", 5, 5), (901, "c0", None, 9), (902, None, 1, 9), (903, "c1", 7, 3)]
    a += [(500, "c1", 16_400, 16_450)] * 20
    r = [(k, f"c{k % 4}", s, s + width()) for k in range(60) if (s := at()) >= 0] + [(900, "c0", 3, 3), (901, None, 1, 9)]
    x = spark.createDataFrame(a, "id int, ref string, ref_start bigint, ref_end bigint")
    y = spark.createDataFrame(r, "region int, ref string, region_start bigint, region_end bigint")
    got = sorted((q.id, q.region) for q in intervals.overlaps(x, y, "ref", hot=hot).collect())
    ok = lambda s, e: s is not None and s < e
    want = sorted((i, j) for i, c, s, e in a for j, d, t, z in r if c == d and c is not None and ok(s, e) and ok(t, z) and s < z and t < e)
    assert got == want and len(want) > 500
    assert intervals.overlaps(x.limit(0), y, "ref").count() == 0 == intervals.overlaps(x, y.limit(0), "ref").count()


def test_far_regions_do_not_meet(spark):
    """Short intervals and regions all over one reference: rows that meet in bins grow with the input, not with its square."""
    x = spark.range(20_000).selectExpr("'c' AS ref", "id * 20000 AS ref_start", "id * 20000 + 100 AS ref_end")
    y = spark.range(20_000).selectExpr("'c' AS ref", "id * 20000 + 50 AS region_start", "id * 20000 + 90 AS region_end", "id")
    assert intervals.overlaps(x, y, "ref").count() == 20_000


def pairs_by_force(rows, gap=(50, 50_000), total=0.7):
    out = []
    for i, p in enumerate(rows):
        for j, q in enumerate(rows):
            if i != j and p[:2] == q[:2] and (p[2], p[3]) < (q[2], q[3]) and gap[0] <= q[2] - p[3] <= gap[1] and min(p[5], q[5]) >= 20 and min(p[4], q[4]) >= 0.15 * 1000 and p[4] + q[4] >= total * 1000:
                out.append((*p[:2], p[3], q[2], p[5], q[5]))
    return sorted(out)


def test_split_alignments(spark):
    rng = np.random.default_rng(2)
    rows = [(f"q{k % 3}", f"c{k % 2}", s, s + n, n, int(rng.integers(0, 61))) for k in range(200) if (s := int(rng.integers(0, 120_000))) >= 0 and (n := int(rng.integers(100, 700)))]
    df = spark.createDataFrame([(q, c, s, e, 0, n, 1000, m, k) for k, (q, c, s, e, n, m) in enumerate(rows)], "query_name string, contig string, ref_start bigint, ref_end bigint, query_start bigint, query_end bigint, query_length bigint, mapq int, ordinal int")
    got = sorted((r.query_name, r.contig, r.insertion_start, r.insertion_end, r.mapq_1, r.mapq_2) for r in hits.split_alignments(df).collect())
    assert got == pairs_by_force(rows) and len(got) > 100
    assert hits.split_alignments(df.limit(0)).count() == 0


def test_a_query_with_many_hits_meets_its_neighbours_only(spark):
    """Hits of one query far apart on one contig: pairs that meet grow with the hits."""
    n = {}
    for k in (500, 1000, 2000):
        h = spark.range(k).select(F.lit("q").alias("query"), F.struct((F.col("id") * 20_000).alias("rs"), (F.col("id") * 20_000 + 500).alias("re"), F.lit(0.5).alias("cov")).alias("h"))
        n[k] = hits._split_pairs(h, ["query"], 0.7, (50, 50_000)).count()
    assert n[2000] <= 4 * 2000 and n[2000] < 2.2 * n[1000]


def test_query_places(spark):
    rows = [("a", 0, "c", 5, 9, "10S20M3I4D7=5S", 0), ("b", 16, "c", 5, 9, "4H6S10M2H", 0), ("c", 4, "*", -1, 0, "*", 0), ("d", 0, "c", 1, 1, "8M", 0)]
    df = spark.createDataFrame(rows, "query_name string, flag int, reference_name string, ref_start bigint, mapq int, cigar string, ref_end bigint")
    assert {r.query_name: (r.contig, r.query_start, r.query_end, r.query_length) for r in hits.query_places(df).collect()} == {"a": ("c", 10, 40, 45), "b": ("c", 6, 16, 22), "d": ("c", 0, 8, 8)}


@pytest.mark.parametrize("parts", [1, 7])
def test_overlap_totals(spark, parts):
    """Numbers and lengths by region as the pairs give them: equal places, crowded ones, touching ends, repeated ids, empty and null rows."""
    rng = np.random.default_rng(parts)
    spans = lambda n: [(k % 40, f"c{k % 3}", s, s + int(rng.choice([1, 5, 300]))) for k in range(n) if (s := int(rng.integers(-20, 60))) is not None]
    odd = [(90, "c0", 5, 5), (91, "c0", None, 9), (92, None, 1, 9), (93, "c1", 7, 3), (94, "far", 1, 9)]
    x = spark.createDataFrame(spans(400) + [(95, "c1", 7, 9)] * 200 + odd[:4], "id int, ref string, ref_start bigint, ref_end bigint")
    y = spark.createDataFrame(spans(90) + [(96, "c1", 7, 9)] * 3 + odd, "region int, ref string, region_start bigint, region_end bigint")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        met = intervals.overlaps(x, y, "ref")
        want = met.groupBy("region").agg(F.count(F.lit(1)), F.sum(F.least("ref_end", "region_end") - F.greatest("ref_start", "region_start")))
        got = intervals.overlap_totals(x, y, "ref", "region")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []
        assert intervals.overlap_totals(x.limit(0), y, "ref", "region").count() == 0 == intervals.overlap_totals(x, y.limit(0), "ref", "region").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_totals_of_many_common_pairs(spark):
    """All intervals meet all regions: 400 million pairs, which none of the steps makes."""
    x = spark.range(20_000).selectExpr("'c' AS ref", "id AS ref_start", "100000 + id AS ref_end")
    y = spark.range(20_000).selectExpr("'c' AS ref", "50000 AS region_start", "50001 + id AS region_end", "id AS region")
    n, bases = intervals.overlap_totals(x, y, "ref", "region").selectExpr("sum(n)", "sum(bases)").first()
    assert (n, bases) == (20_000**2, 20_000 * sum(range(1, 20_001)))
