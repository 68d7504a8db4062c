"""Behaviours that are easy to get wrong."""

import math
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lociq.functions import sequence as fs
from lociq.operators import backjump, batches, graph, guides, hits, nesting, orfs, ranking
from lociq.plans.catalog import QUERIES
from louvain import louvain, modularity


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_greedy_clusters_do_not_merge():
    fold = backjump.GreedyClusters(20)
    assert [fold.place(*p) for p in ((100, 500), (105, 540), (110, 520))] == [0, 1, 0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 120), st.integers(0, 90)), max_size=80), st.integers(0, 25))
def test_greedy_clusters_are_those_of_all_members(points, tolerance):
    members = []
    for x, y in sorted(points):
        near = [k for a, b, k in members if x - a <= tolerance and abs(y - b) <= tolerance]
        members.append((x, y, min(near, default=len({k for _, _, k in members}))))
    fold = backjump.GreedyClusters(tolerance)
    assert [fold.place(x, y) for x, y in sorted(points)] == [k for _, _, k in members]


def test_clusters_are_folded_over_places_and_not_over_reads(spark):
    """A hundred reads of one place are one step of the fold."""
    rows = [(read, ref, x, x + 300, 1) for ref in (1, 2) for x in (100, 110, 200) for read in range(100)]
    jumps = spark.createDataFrame(rows, "read_id long, ref_id long, circle_start long, circle_end long, seg long")
    found = backjump.cluster_breakpoints(jumps).collect()
    assert len(found) == 600 and {(r.ref_id, r.circle_start, r.island, r.cluster) for r in found} == {(ref, *w) for ref in (1, 2) for w in ((100, 1, 0), (110, 1, 0), (200, 2, 0))}
    assert backjump.places(jumps).count() == 6


def test_median_is_cut(spark):
    assert spark.createDataFrame([(v,) for v in (1, 2, 4, 5)], "v long").agg(F.floor(F.median("v"))).first()[0] == 3


def test_cigar_blocks(spark):
    got = one(spark, fs.cigar_blocks(F.lit("100=5X200D10I90=3D20="), F.lit(0), F.lit(7), 50))
    assert [tuple(b) for b in got] == [(0, 105, 7, 112, 100, 105), (105, 225, 312, 425, 110, 110)]
    assert one(spark, fs.cigar_blocks(F.lit("10S60I"), F.lit(0), F.lit(0), 50)) == []
    assert one(spark, fs.cigar_reference_length(F.lit("5S10M2I3D4N=1X"))) == 18


def test_entropy(spark):
    assert one(spark, fs.entropy(F.lit("ACGTNNacgt"))) == pytest.approx(2.321928, abs=1e-6)
    assert one(spark, fs.entropy(F.lit(""))) == 0
    assert one(spark, fs.entropy(F.lit("AAAA"))) == 0


def test_names(spark):
    assert [one(spark, c) for c in fs.reference_header(F.lit("IS_A_1_IS3_IS150"))] == ["IS_A_1", "IS3", "IS150"]
    assert [one(spark, c) for c in fs.reference_header(F.lit("plain"))] == [None] * 3
    assert one(spark, fs.slugify(F.lit("  E. coli (K-12) "))) == "e_coli_k_12"
    assert one(spark, fs.genus(F.lit("Listeria monocytogenes serovar 4b"))) == "Listeria"
    assert one(spark, fs.sample_of_file(F.lit("SRR1_subreads.fastq.gz"))) == "SRR1"
    assert one(spark, fs.orf_label(F.lit(""), F.lit("a" * 40), F.lit(2))) == "a" * 27 + "..."
    assert one(spark, fs.human_size(F.lit(1536))) == "1.5 KB"
    assert one(spark, fs.without_stops(F.lit("MK**"))) == "MK"


def test_hamming_positions(spark):
    assert one(spark, fs.hamming_positions(F.lit("ACGT"), F.lit("AGGTT"))) == [1]
    assert one(spark, fs.hamming_positions(F.lit(""), F.lit("A"))) == []


def test_padding(spark):
    assert one(spark, fs.padded(F.lit("AAC"), F.lit("G"), F.lit("TTA"), 2)) == "ACGTT"
    assert one(spark, fs.padded(F.lit("AAC"), F.lit("G"), F.lit("TTA"), 0)) == "AACG"


X, X12 = "ACGATTGCA", "ACGATTGCATCC"


def found(spark, a, b):
    rows = guides.guide_hits(spark.createDataFrame([(1, a, b)], "key int, flank_seq string, nc_seq string")).collect()
    return [(r.length, r.mismatches) for r in rows if r.orientation == "forward"], [r for r in rows if r.orientation != "forward"]


def test_guides(spark):
    assert found(spark, f"TT{X}TT", f"GG{X}GG")[0] == []  # grows to 10 with a mismatch and fails the length rule
    assert found(spark, X, X)[0] == [(9, 0)]
    assert found(spark, f"TT{X12}TT", f"GG{X12}GG")[0] == [(13, 1)]
    w = "ACGATTGCATCCGTA"
    rc = found(spark, w, w.translate(str.maketrans("ACGT", "TGCA"))[::-1])[1]
    assert rc and all(r.length == 9 for r in rc)


def test_guide_summary_of_nothing(spark):
    pairs = spark.createDataFrame([(1, "ACG", "ACG")], "key int, flank_seq string, nc_seq string")
    assert tuple(guides.guide_summary(guides.guide_hits(pairs), pairs).first()) == (1, 0, 0, False)


def test_round_robin_drops_null_organisms(spark):
    rows = [(k, "a" if k < 5 else "b" if k < 8 else None) for k in range(10)]
    got = batches.round_robin(spark.createDataFrame(rows, "srr_accession int, organism string"), 3).collect()
    assert len(got) == 8 and Counter(r.batch for r in got) == {0: 3, 1: 3, 2: 2}
    assert Counter(r.batch for r in got if r.organism == "a") == {0: 2, 1: 2, 2: 1}


def test_orf_gaps_use_the_last_start(spark):
    o = spark.createDataFrame([("e", 1, 100, 1), ("e", 20, 50, 2)], "is_id string, orf_start int, orf_end int, ordinal int")
    e = spark.createDataFrame([("e", 120), ("f", 30)], "is_id string, seq_len int")
    got = {(r.is_id, r.start, r.end, r.type) for r in orfs.noncoding_regions(o, e).collect()}
    assert got == {("e", 51, 120, "3_prime"), ("f", 1, 30, "full")}


def test_evidence_passes(spark):
    g = spark.createDataFrame([("a", 1), ("b", 0), ("c", 0)], "is_id string, n_tail_head_reads int")
    a = spark.createDataFrame([("a",), ("d",), ("e",)], "is_id string")
    p = spark.createDataFrame([("a",), ("c",), ("d",)], "is_id string")
    assert dict(map(tuple, hits.split_evidence(g, a, p).collect())) == {"a": "full", "b": "none", "c": "partial", "d": "partial", "e": "none"}


def test_novelty_without_members(spark):
    s = spark.createDataFrame([(1, 1, 0, 0, 0.0, 0, 0, 1, 1)], "cluster_id int, cluster_size int, n_with_match int, n_without_match int, mean_pident double, n_distinct_families int, n_distinct_names int, n_l1_groups int, n_l2_groups int")
    r = hits.novelty(s).first()
    assert (r.divergence_score, r.diversity_score, r.mosaic_score, r.novelty_score, r.novelty_class) == (1.0, 0.0, 0.5, 0.6, "divergent")


def test_equal_lengths_do_not_nest(spark):
    b = spark.createDataFrame([("a", "b", "+", 0, 100, 0, 100, 100, 100, 1), ("a", "b", "+", 100, 200, 400, 500, 100, 100, 2)], "query string, target string, strand string, qs long, qe long, ts long, te long, matches long, aligned long, ordinal long")
    sizes = lambda n: spark.createDataFrame([("a", 500), ("b", n)], "id string, ext_length int")
    assert nesting.oriented_blocks(b, sizes(500)).count() == 0
    r = nesting.nesting_events(nesting.oriented_blocks(b, sizes(800))).first()
    assert (r.host, r.core, r.n_insertions, r.total_insertion_bp, r.alignment_coverage) == ("b", "a", 1, 300, 0.4)


def test_first_longest_and_mode(spark):
    d = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (1, "y", 3), (1, "x", 4), (1, None, 0)], "k int, v string, o int")
    assert ranking.most_common(d, ["k"], "v", "o", "m").first().m == "x"
    assert d.where("o > 0").agg(ranking.upper_median(F.col("o"))).first()[0] == 3
    assert ranking.upper_median_of(d.where("o > 0"), "o", "m").first().m == 3


def test_single_linkage_is_transitive(spark):
    a = "ACGT" * 10
    rows = [("c", 1, a), ("c", 2, a[8:] + "AAAAAAAA"), ("c", 3, a[16:] + "AAAAAAAAGGGGGGGG")]
    m = spark.createDataFrame(rows, "cluster string, is_id int, seq string")
    assert {r.l1 for r in graph.flank_variants(m, 16).collect()} == {1}


def brute_components(edges):
    p = {}
    find = lambda x: x if p.setdefault(x, x) == x else find(p[x])
    for a, b in edges:
        x, y = find(a), find(b)
        p[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(p)}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), min_size=1, max_size=40))
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a int, b int")
    want = {k: v for k, v in brute_components(edges).items() if any(k in e and e[0] != e[1] for e in edges)}
    assert {r.node: r.component for r in graph.components(df).collect()} == want


@settings(max_examples=30, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 14), st.integers(0, 14)).filter(lambda e: e[0] < e[1]), min_size=1, max_size=40))
def test_louvain_beats_one_community(edges):
    e = [(a, b, 1.0) for a, b in sorted(edges)]
    label = louvain(15, e)
    assert label == louvain(15, e)
    assert modularity(e, label) >= modularity(e, list(range(15))) - 1e-9
    assert modularity(e, label) >= modularity(e, [0] * 15) - 1e-9


def test_communities_refine_components(spark):
    cliques = [(b + i, b + j, 1.0) for b in (0, 10, 20) for i in range(5) for j in range(i)] + [(0, 10, 0.5)]
    e = spark.createDataFrame([(min(a, b), max(a, b), w) for a, b, w in cliques], "a long, b long, similarity double")
    nodes = spark.range(31).withColumnRenamed("id", "node")
    got = {r.node: r.community for r in graph.communities(e, nodes).collect()}
    assert len(got) == 31 and {got[k] for k in range(5)} == {0} and {got[k] for k in range(10, 15)} == {10} and got[30] == 30


def gains(edges, label):
    """The best gain of modularity of each community by moving one node to a community near it, by recounting."""
    best, near = {c: 0.0 for c in label.values()}, {}
    for a, b, _ in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    names = {n: k for k, n in enumerate(sorted(label))}
    whole = [(names[a], names[b], w) for a, b, w in edges]
    score = lambda x: modularity(whole, [x[n] for n in sorted(x)])
    now = score(label)
    for n in near:
        for c in {label[v] for v in near[n]} - {label[n]}:
            best[label[n]] = max(best[label[n]], score(label | {n: c}) - now)
    return best


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_communities_hang_together_and_no_node_gains_by_moving(spark, seed):
    rng = __import__("numpy").random.default_rng(seed)
    pairs = {tuple(sorted(map(int, rng.integers(0, 40, 2)))) for _ in range(90)}
    edges = [(a, b, float(rng.integers(1, 9)) / 8) for a, b in sorted(pairs) if a != b]
    e = spark.createDataFrame(edges, "a long, b long, similarity double")
    nodes = spark.range(42).withColumnRenamed("id", "node")
    found = graph.communities(e, nodes)
    label = {r.node: r.community for r in found.collect()}
    shown = {r.community: r for r in graph.community_certificate(e, found).collect()}
    assert all(r.parts == 1 and r.best_gain <= 1e-9 for r in shown.values()) and sum(r["size"] for r in shown.values()) == 42
    assert max(gains(edges, label).values()) <= 1e-8
    poor = {n: n % 5 for n in range(42)}
    shown = {r.community: r for r in graph.community_certificate(e, spark.createDataFrame(list(poor.items()), "node long, community long")).collect()}
    for c, gain in gains(edges, poor).items():
        inside = [(a, b) for a, b, _ in edges if poor[a] == poor[b] == c]
        assert abs(shown[c].best_gain - gain) < 1e-8
        assert shown[c].parts == sum(n % 5 == c for n in range(42)) - len(set(brute_components(inside))) + len(set(brute_components(inside).values()))


def test_communities_of_chains_and_cliques(spark):
    edges = [(k, k + 1, 1.0) for k in range(19)] + [(100 + 5 * c + i, 100 + 5 * c + j, 1.0) for c in range(3) for j in range(5) for i in range(j)]
    edges += [(100 + 5 * c, 105 + 5 * c, 0.5) for c in range(2)]
    e = spark.createDataFrame(edges, "a long, b long, similarity double")
    nodes = spark.createDataFrame([(n,) for n in {x for a, b, _ in edges for x in (a, b)}], "node long")
    got = {r.node: r.community for r in graph.communities(e, nodes).collect()}
    names = {n: k for k, n in enumerate(sorted(got))}
    whole = [(names[a], names[b], w) for a, b, w in edges]
    score = modularity(whole, [got[n] for n in sorted(got)])
    assert score >= modularity(whole, louvain(len(names), whole)) - 0.03
    assert all(c == min(n for n in got if got[n] == c) for c in got.values())


def test_graph_queries_take_all_ids(spark, tmp_path):
    orders = [(k, c) for k, c in enumerate((1, 300, 301, 5000))]
    items = [(k, s) for k in range(4) for s in ((1, 2, 3, 4, 5, 6, 7, 8) if k < 2 else (1, 2, 3, 10 + k, 20 + k))]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(items, "l_orderkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, 0) for k in (1, 101)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(0, "X")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    run = lambda name: QUERIES[name](spark, str(tmp_path)).collect()
    assert {r.is_id for r in run("incidence")} == {1, 300, 301, 5000}
    assert {(r.a, r.b) for r in run("jaccard_edges")} == {(1, 300), (1, 301), (1, 5000), (300, 301), (300, 5000), (301, 5000)} and 0.3 <= min(r.similarity for r in run("jaccard_edges")) < 0.34
    assert {r.component for r in run("components")} == {1}
    assert {r.node for r in run("louvain_communities")} == {1, 300, 301, 5000} and sum(r["size"] for r in run("system_clusters")) == 4
    assert {r.sample for r in run("sample_ref_cross")} == {1, 101}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text("ACGTNacgt", max_size=30), min_size=1, max_size=10))
def test_entropy_and_revcomp_models(spark, seqs):
    rows = spark.createDataFrame([(s,) for s in seqs], "s string").select("s", fs.entropy(F.col("s")).alias("e"), fs.revcomp(fs.revcomp(F.col("s"))).alias("r")).collect()
    for r in rows:
        n = Counter(r.s.upper())
        assert r.e == pytest.approx(-sum(k / len(r.s) * math.log2(k / len(r.s)) for k in n.values()) if r.s else 0, abs=1e-9)
        assert r.r == r.s


def test_global_numbers(spark):
    d = spark.range(1000).withColumn("v", F.col("id") * 7919 % 1000)
    got = ranking.global_row_number(d, [F.col("v")], "k").collect()
    assert all(r.k == r.v + 1 for r in got) and len(got) == 1000


def test_hits_keep_order_on_ties(spark):
    h = spark.createDataFrame([("q", "s1", 1, 90, 100, 50.0, 2, "A"), ("q", "s2", 1, 90, 100, 50.0, 1, "B"), ("q", "s3", 1, 10, 100, 99.0, 0, "C")], "qseqid string, sseqid string, qstart int, qend int, qlen int, bitscore double, ordinal int, hit_name string")
    got = hits.ranked_hits(h).orderBy("rank").collect()
    assert [r.hit_name for r in got] == ["B", "A"]


def test_sequences_are_made_once_for_all_their_letters(spark):
    """A Python function cannot run for each letter, so it shows whether what makes a sequence is evaluated outside of the walk over its letters."""
    from pyspark.sql import functions as F

    same = F.udf(lambda x: x, "string")
    rows = spark.createDataFrame([("ACGT", "AGGTT"), ("", "A"), (None, "A"), ("AAAA", None), (None, None)], "a string, b string")
    got = rows.select(fs.hamming_positions(same("a"), same("b")).alias("p"), F.round(fs.entropy(same("a")), 6).alias("e")).collect()
    assert [tuple(r) for r in got] == [([1], 2.0), ([], 0.0), ([], None), ([], 0.0), (None, None)]
