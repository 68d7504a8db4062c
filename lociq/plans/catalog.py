"""Registered queries over the driver's tables, each with the oracle's SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociq.functions import sequence as fs
from lociq.operators import backjump, batches, graph, guides, hits, junctions, nesting, orfs, ranking, similarity
from lociq.plans.fixtures import Tables, oracle
from lociq.storage import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *views: str):
    """Register a function of Tables under its name, with the oracle's body over views."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = oracle(sql, *views)
        return f

    return add


# junctions

_CLASSIFIED = """
c AS (SELECT a.*, t.uuid, a.ref_start <= 400 AND a.ref_end >= 600 AS th,
      a.left_clip >= 100 AND a.ref_end - a.ref_start >= 100 AND (a.ref_start < 50 OR abs(a.ref_start - 500) < 50) AS gh,
      a.right_clip >= 100 AND a.ref_end - a.ref_start >= 100 AND (abs(a.ref_end - 500) < 50 OR abs(a.ref_end - 1000) < 50) AS tg
      FROM aln a JOIN targets t ON a.ref_id = t.ref_id)"""


@query(f"""WITH {_CLASSIFIED}
SELECT t.uuid, t.n, COALESCE(count(*) FILTER (th), 0) AS n_tail_head_reads, COALESCE(count(*) FILTER (gh), 0) AS n_genome_head_reads, COALESCE(count(*) FILTER (tg), 0) AS n_tail_genome_reads, count(c.uuid) AS n_total_mapped
FROM targets t LEFT JOIN c ON t.uuid = c.uuid GROUP BY t.uuid, t.n""", "aln", "targets")
def junction_summary(t: Tables) -> DataFrame:
    return junctions.junction_summary(junctions.classified(t.aln, t.targets), t.targets)


@query(f"""WITH {_CLASSIFIED}
SELECT read_id, seg, uuid, ref_start, ref_end, k AS junction_type FROM c, (VALUES ('tail_head'), ('genome_head'), ('tail_genome')) v(k)
WHERE (k = 'tail_head' AND th) OR (k = 'genome_head' AND gh) OR (k = 'tail_genome' AND tg)""", "aln", "targets")
def junction_reads(t: Tables) -> DataFrame:
    return junctions.junction_reads(junctions.classified(t.aln, t.targets)).select("read_id", "seg", "uuid", "ref_start", "ref_end", "junction_type")


@query(f"""WITH {_CLASSIFIED}
SELECT uuid, read_id AS example_read FROM (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY mapq DESC, ref_end - ref_start DESC, read_id, seg) AS k FROM c WHERE th) WHERE k = 1""", "aln", "targets")
def junction_example_read(t: Tables) -> DataFrame:
    return junctions.example_reads(junctions.classified(t.aln, t.targets))


# sequences and names

_ENTROPY = """WITH b AS (SELECT is_id, sequence, unnest(string_split(upper(sequence), '')) AS ch FROM elem), n AS (SELECT is_id, sequence, ch, count(*) AS k FROM b GROUP BY is_id, sequence, ch),
q AS (SELECT is_id, sequence, k / length(sequence)::DOUBLE AS p FROM n), h AS (SELECT is_id, sequence, round(sum(-p * log2(p)), 9) AS bits FROM q GROUP BY is_id, sequence)"""


@query(_ENTROPY + " SELECT e.is_id, COALESCE(h.bits, 0.0) AS bits FROM elem e LEFT JOIN h ON e.is_id = h.is_id", "elem")
def seq_entropy(t: Tables) -> DataFrame:
    return t.elem.select("is_id", (F.round(fs.entropy(F.col("sequence")), 9) + 0.0).alias("bits"))


@query(_ENTROPY + " SELECT is_id, length(sequence)::BIGINT AS n FROM h WHERE length(sequence) >= 200 AND bits >= 1.7", "elem")
def low_complexity_filter(t: Tables) -> DataFrame:
    s = F.col("sequence")
    kept = F.transform(F.array(s), lambda x: (F.length(x) > 0) & (x != "NA") & (F.length(x) >= 200) & (F.round(fs.entropy(x), 9) >= 1.7))[0]  # the view's sequence is made once
    return t.elem.where(kept).select("is_id", F.length(s).cast("long").alias("n"))


@query("SELECT is_id, reverse(translate(sequence, 'ACGTacgt', 'TGCAtgca')) AS rc FROM elem", "elem")
def revcomp(t: Tables) -> DataFrame:
    return t.elem.select("is_id", fs.revcomp(F.col("sequence")).alias("rc"))


@query("""SELECT is_id, len(p)::BIGINT AS mismatches, COALESCE(array_to_string(p, ','), '') AS positions FROM (
SELECT is_id, list_filter(range(0, least(length(left(sequence, 80)), length(right(sequence, 80)))), lambda i: substr(left(sequence, 80), i + 1, 1) <> substr(right(sequence, 80), i + 1, 1)) AS p FROM elem)""", "elem")
def hamming_positions(t: Tables) -> DataFrame:
    p = fs.hamming_positions(F.expr("left(sequence, 80)"), F.expr("right(sequence, 80)"))
    return t.elem.select("is_id", p.alias("p")).select("is_id", F.size("p").cast("long").alias("mismatches"), F.array_join(F.col("p").cast("array<string>"), ",").alias("positions"))


@query("SELECT page_id, trim(regexp_replace(lower(trim(url)), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM pages")
def slugify(t: Tables) -> DataFrame:
    return t.pages.select("page_id", fs.slugify(F.col("url")).alias("slug"))


@query("SELECT s_suppkey, regexp_replace(split_part(s_name || CASE s_suppkey % 4 WHEN 0 THEN '_1.fastq' WHEN 1 THEN '_subreads.bam' WHEN 2 THEN '_2.fq.gz' ELSE '.fa' END, '.', 1), '_(1|2|subreads)$', '') AS sample FROM supplier")
def sample_from_filename(t: Tables) -> DataFrame:
    name = F.concat("s_name", F.expr("CASE s_suppkey % 4 WHEN 0 THEN '_1.fastq' WHEN 1 THEN '_subreads.bam' WHEN 2 THEN '_2.fq.gz' ELSE '.fa' END"))
    return t.supplier.select("s_suppkey", fs.sample_of_file(name).alias("sample"))


@query("""WITH m AS (SELECT sample_id AS cluster, is_id, concat(left(sequence, 80), right(sequence, 80)) AS seq FROM elem)
SELECT x.cluster, x.is_id AS a, y.is_id AS b, levenshtein(x.seq, y.seq)::BIGINT AS distance FROM m x JOIN m y ON x.cluster = y.cluster AND x.is_id < y.is_id WHERE levenshtein(x.seq, y.seq) <= 10""", "elem")
def levenshtein_pairs(t: Tables) -> DataFrame:
    return similarity.edit_distance_pairs(_members(t)).select("cluster", "a", "b", F.col("distance").cast("long").alias("distance"))


def _members(t: Tables) -> DataFrame:
    return t.elem.selectExpr("sample_id AS cluster", "is_id", "concat(left(sequence, 80), right(sequence, 80)) AS seq", "left(sequence, 2) AS guide")


def _stored_members(t: Tables) -> DataFrame:
    """Members by themselves: whole texts are read and translated once, not for each step that asks for members."""
    return stored(_members(t), "members")


@query(r"""SELECT t.l_orderkey AS id, count(*) AS n, sum(t.k)::BIGINT AS reference_bases FROM (
SELECT l_orderkey, l_partkey % 90 + CAST(l_quantity AS BIGINT) + l_suppkey % 7 AS k FROM lineitem) t GROUP BY t.l_orderkey""")
def cigar_reference_length(t: Tables) -> DataFrame:
    cigar = F.expr("concat(l_partkey % 90, 'M', l_partkey % 5, 'I', CAST(l_quantity AS BIGINT), 'D', l_suppkey % 7, 'X', l_suppkey % 3, 'S')")
    rows = t.lineitem.select("l_orderkey", fs.cigar_reference_length(cigar).alias("k"))
    return rows.groupBy(F.col("l_orderkey").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("reference_bases"))


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) * 4 AS d, l_partkey % 90 + 1 AS a, l_suppkey % 60 + 1 AS b FROM lineitem),
r AS (SELECT l_orderkey AS id, l_linenumber AS line, 1 AS block, 0 AS qs, CASE WHEN d >= 50 THEN a ELSE a + b END AS qe, 7 AS ts, CASE WHEN d >= 50 THEN 7 + a ELSE 7 + a + d + b END AS te FROM p
UNION ALL SELECT l_orderkey, l_linenumber, 2, a, a + b, 7 + a + d, 7 + a + d + b FROM p WHERE d >= 50)
SELECT id, line, block, count(*) AS n, sum(qs)::BIGINT AS qs, sum(qe)::BIGINT AS qe, sum(ts)::BIGINT AS ts, sum(te)::BIGINT AS te FROM r GROUP BY id, line, block""")
def cigar_blocks(t: Tables) -> DataFrame:
    cigar = F.expr("concat(l_partkey % 90 + 1, '=', CAST(l_quantity AS BIGINT) * 4, 'D', l_suppkey % 60 + 1, 'M')")
    b = t.lineitem.select("l_orderkey", "l_linenumber", F.posexplode(fs.cigar_blocks(cigar, F.lit(0), F.lit(7), 50)).alias("k", "b"))
    return b.groupBy(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), (F.col("k") + 1).alias("block")).agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"b.{c}").alias(c) for c in ("qs", "qe", "ts", "te")])


# windows over alignments

_JUMPS = """j AS (SELECT *, lead(ref_start) OVER w AS ns, lead(ref_end) OVER w AS ne, lead(mapq) OVER w AS nq FROM aln WINDOW w AS (PARTITION BY read_id, ref_id, is_reverse ORDER BY query_start, seg)),
jumps AS (SELECT read_id, ref_id, ns AS circle_start, ref_end AS circle_end, ref_end - ns AS circle_size, ref_end - ref_start AS overlap_before, ne - ns AS overlap_after, least(mapq, nq) AS mapping_quality, seg
FROM j WHERE ref_end > ns AND ref_end - ns >= 100 AND (ref_end - ns) / 1000.0::DOUBLE <= 0.9 AND ref_end - ref_start >= 50 AND ne - ns >= 50)"""


@query(f"WITH {_JUMPS} SELECT * FROM jumps", "aln")
def back_jumps(t: Tables) -> DataFrame:
    return backjump.back_jumps(t.aln, 1000)


@query(f"""WITH RECURSIVE {_JUMPS},
p AS (SELECT *, row_number() OVER (PARTITION BY ref_id ORDER BY circle_start, circle_end, read_id, seg) AS i FROM jumps),
f(ref_id, i, xs, ys, cs) AS (SELECT ref_id, i, [circle_start], [circle_end], [0] FROM p WHERE i = 1
UNION ALL SELECT f.ref_id, p.i, list_append(xs, circle_start), list_append(ys, circle_end), list_append(cs, COALESCE(list_min(list_transform(list_filter(range(1, len(xs) + 1), lambda k: abs(xs[k] - circle_start) <= 20 AND abs(ys[k] - circle_end) <= 20),
lambda k: cs[k])), list_max(cs) + 1)) FROM f JOIN p ON p.ref_id = f.ref_id AND p.i = f.i + 1),
l AS (SELECT ref_id, unnest(cs) AS cluster, generate_subscripts(cs, 1) AS i FROM (SELECT *, row_number() OVER (PARTITION BY ref_id ORDER BY i DESC) AS k FROM f) WHERE k = 1),
g AS (SELECT ref_id, cluster, floor(median(circle_start))::BIGINT AS circle_start, floor(median(circle_end))::BIGINT AS circle_end, count(*) AS n_supporting_reads, round(avg(mapping_quality), 1) AS mean_mapq,
string_agg(read_id, ',' ORDER BY read_id) AS supporting_read_names FROM p JOIN l USING (ref_id, i) GROUP BY ref_id, cluster)
SELECT ref_id, circle_start, circle_end, n_supporting_reads, mean_mapq, supporting_read_names, circle_end - circle_start AS circle_size, round((circle_end - circle_start) / 1000.0::DOUBLE, 4) AS circle_fraction
FROM g WHERE n_supporting_reads >= 2 AND circle_end - circle_start >= 100 AND (circle_end - circle_start) / 1000.0::DOUBLE <= 0.9""", "aln")
def partial_circles(t: Tables) -> DataFrame:
    return backjump.partial_circles(backjump.back_jumps(t.aln, 1000), 1000).withColumn("supporting_read_names", F.array_join(F.col("supporting_read_names").cast("array<string>"), ","))


@query("""WITH g AS (SELECT *, lag(core_end) OVER w AS ce, lag(host_end) OVER w AS he FROM blocks WINDOW w AS (PARTITION BY pair_id ORDER BY core_start, seg))
SELECT pair_id, core_start, seg, ce AS core_position, he AS insertion_start, host_start AS insertion_end, host_start - he - greatest(core_start - ce, 0) AS insertion_size FROM g WHERE host_start - he - greatest(core_start - ce, 0) >= 50""", "blocks")
def insertion_gaps(t: Tables) -> DataFrame:
    return nesting.insertion_gaps(t.blocks, ["pair_id"], ["core_start", "seg"])


@query("""WITH g AS (SELECT pair_id, host_start, lag(host_start) OVER (PARTITION BY pair_id ORDER BY core_start, seg) AS before FROM blocks)
SELECT pair_id, bool_and(COALESCE(host_start >= before, true)) AS is_collinear, count(*) AS n_blocks FROM g GROUP BY pair_id""", "blocks")
def collinear_blocks(t: Tables) -> DataFrame:
    return nesting.collinear(t.blocks, ["pair_id"], ["core_start", "seg"])


@query("""WITH p AS (SELECT pair_id, seg, core_start, core_end, host_start, host_end, 1500 + pair_id % 100 AS core_len, 1540 + pair_id % 60 AS host_len FROM blocks),
o AS (SELECT pair_id, seg, 'h' AS h, 'c' AS c, core_start, core_end, host_start, host_end, core_len FROM p WHERE host_len >= core_len AND host_len / core_len::DOUBLE >= 1.02
UNION ALL SELECT pair_id, seg, 'c', 'h', host_start, host_end, core_start, core_end, host_len FROM p WHERE host_len < core_len AND core_len / host_len::DOUBLE >= 1.02),
g AS (SELECT *, lag(core_end) OVER w AS ce, lag(host_end) OVER w AS he, lag(host_start) OVER w AS hs FROM o WINDOW w AS (PARTITION BY pair_id ORDER BY core_start, seg)),
k AS (SELECT pair_id, max(h) AS h, max(c) AS c, bool_and(COALESCE(host_start >= hs, true)) AS ok, count(*) AS n_aligned_blocks, sum(core_end - core_start)::BIGINT AS total_aligned_bp, round(sum(core_end - core_start) / max(core_len)::DOUBLE, 4) AS alignment_coverage FROM g GROUP BY pair_id),
i AS (SELECT pair_id, count(*) AS n_insertions, sum(host_start - he - greatest(core_start - ce, 0))::BIGINT AS total_insertion_bp FROM g WHERE host_start - he - greatest(core_start - ce, 0) >= 50 GROUP BY pair_id)
SELECT concat(h, pair_id) AS host, concat(c, pair_id) AS core, n_aligned_blocks, total_aligned_bp, alignment_coverage, n_insertions, total_insertion_bp FROM k JOIN i USING (pair_id) WHERE ok""", "blocks")
def nesting_events(t: Tables) -> DataFrame:
    sizes = t.orders.selectExpr("concat('c', o_orderkey) AS id", "1500 + o_orderkey % 100 AS ext_length").union(t.orders.selectExpr("concat('h', o_orderkey) AS id", "1540 + o_orderkey % 60 AS ext_length"))
    b = t.blocks.selectExpr("concat('c', pair_id) AS query", "concat('h', pair_id) AS target", "'+' AS strand", "core_start AS qs", "core_end AS qe", "host_start AS ts", "host_end AS te", "150 AS matches", "150 AS aligned", "seg AS ordinal")
    b = nesting.oriented_blocks(b, sizes)
    return nesting.nesting_events(b).select("host", "core", "n_aligned_blocks", "total_aligned_bp", "alignment_coverage", F.col("n_insertions").cast("long").alias("n_insertions"), "total_insertion_bp")


# hits

_PAIRS = """h AS (SELECT *, (qend - qstart + 1) / qlen::DOUBLE AS cov, least(sstart, send) AS rs, greatest(sstart, send) AS re FROM hsp WHERE pident >= 80),
k AS (SELECT * FROM h WHERE cov >= 0.15),
m AS (SELECT x.qseqid, x.sseqid, CASE WHEN x.rs > y.rs THEN y ELSE x END AS p, CASE WHEN x.rs > y.rs THEN x ELSE y END AS q FROM k x JOIN k y ON x.qseqid = y.qseqid AND x.sseqid = y.sseqid
      AND (x.ordinal, x.qstart, x.qend, x.rs, x.re) < (y.ordinal, y.qstart, y.qend, y.rs, y.re)
      WHERE x.cov + y.cov >= 0.7 AND greatest(0, least(x.qend, y.qend) - greatest(x.qstart, y.qstart) + 1) <= 50),
pairs AS (SELECT qseqid, sseqid, p.ordinal AS ordinal_1, q.ordinal AS ordinal_2, p.qstart AS query_start_1, p.qend AS query_end_1, q.qstart AS query_start_2, q.qend AS query_end_2,
          p.re AS insertion_start, q.rs AS insertion_end, q.rs - p.re AS insertion_length, p.cov + q.cov AS query_coverage FROM m WHERE q.rs - p.re BETWEEN 50 AND 50000)"""


@query(f"WITH {_PAIRS} SELECT * FROM pairs", "hsp")
def split_pairs(t: Tables) -> DataFrame:
    return hits.split_pairs(t.hsp)


@query(f"WITH {_PAIRS} SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY qseqid, sseqid ORDER BY query_coverage DESC, insertion_start, insertion_end, ordinal_1, ordinal_2) AS k FROM pairs) WHERE k = 1", "hsp")
def split_best(t: Tables) -> DataFrame:
    return hits.best_splits(hits.split_pairs(t.hsp))


@query(f"WITH {_PAIRS} SELECT count(*) AS n, min(insertion_length) AS shortest, max(insertion_length) AS longest, list_sort(list(insertion_length))[count(*) // 2 + 1] AS upper_median FROM pairs", "hsp")
def insertion_length_summary(t: Tables) -> DataFrame:
    p = stored(hits.split_pairs(t.hsp).select("insertion_length"), "insertion-lengths")
    ends = p.agg(F.count(F.lit(1)).alias("n"), F.min("insertion_length").alias("shortest"), F.max("insertion_length").alias("longest"))
    return ends.join(F.broadcast(ranking.upper_median_of(p, "insertion_length", "upper_median")))  # one row each


_RANKED = """r AS (SELECT *, row_number() OVER (PARTITION BY qseqid ORDER BY bitscore DESC, ordinal, sseqid, qstart) AS rank FROM (SELECT *, (abs(qend - qstart) + 1) / qlen::DOUBLE AS query_coverage FROM hsp) WHERE query_coverage >= 0.3)"""
_ANNOTATED = f"""{_RANKED},
u AS (SELECT *, CASE WHEN hit_group <> 'G0' THEN hit_group ELSE hit_name END AS family FROM r),
f AS (SELECT qseqid, string_agg(family, ',' ORDER BY first) AS fams, count(*) AS nf FROM (SELECT qseqid, family, min(rank) AS first FROM u GROUP BY ALL) GROUP BY qseqid),
nm AS (SELECT qseqid, string_agg(hit_name, ',' ORDER BY first) AS names, count(*) AS nn FROM (SELECT qseqid, hit_name, min(rank) AS first FROM u GROUP BY ALL) GROUP BY qseqid),
c AS (SELECT qseqid, count(*) AS n_hits FROM u GROUP BY qseqid),
ann AS (SELECT e.is_id, b.hit_name AS best_hit_name, b.family AS best_hit_family, b.pident, b.query_coverage, COALESCE(fams, '') AS all_hit_families, COALESCE(names, '') AS all_hit_names, COALESCE(nf, 0) > 1 AS is_multi_family, COALESCE(n_hits, 0) AS n_hits
        FROM elements e LEFT JOIN (SELECT * FROM u WHERE rank = 1) b ON e.is_id = b.qseqid LEFT JOIN f ON e.is_id = f.qseqid LEFT JOIN nm ON e.is_id = nm.qseqid LEFT JOIN c ON e.is_id = c.qseqid)"""


@query(f"WITH {_RANKED} SELECT qseqid, hit_name, bitscore, query_coverage FROM r WHERE rank = 1", "hsp")
def best_hits(t: Tables) -> DataFrame:
    return hits.ranked_hits(t.hsp).where("rank = 1").select("qseqid", "hit_name", "bitscore", "query_coverage")


def _annotation(t: Tables) -> DataFrame:
    h = t.hsp.withColumn("hit_family", F.col("hit_name")).withColumn("hit_group", F.expr("CASE WHEN hit_group = 'G0' THEN 'unknown' ELSE hit_group END"))
    return hits.annotate(t.elements, hits.ranked_hits(h))


@query(f"WITH {_ANNOTATED} SELECT * FROM ann", "hsp", "elements")
def hit_annotation(t: Tables) -> DataFrame:
    a = _annotation(t)
    return a.select("is_id", "best_hit_name", "best_hit_family", "pident", "query_coverage", F.array_join("all_hit_families", ",").alias("all_hit_families"), F.array_join("all_hit_names", ",").alias("all_hit_names"), "is_multi_family", "n_hits")


_CLUSTERS = "cl AS (SELECT o_orderkey AS is_id, o_custkey AS cluster_id, o_orderkey AS ordinal FROM orders)"
_STATS = f"""{_ANNOTATED}, {_CLUSTERS},
ff AS (SELECT cluster_id, count(DISTINCT x) AS nf FROM (SELECT cluster_id, unnest(string_split(all_hit_families, ',')) AS x FROM cl JOIN ann USING (is_id)) WHERE x <> '' GROUP BY 1),
gg AS (SELECT cluster_id, count(DISTINCT x) AS nn FROM (SELECT cluster_id, unnest(string_split(all_hit_names, ',')) AS x FROM cl JOIN ann USING (is_id)) WHERE x <> '' GROUP BY 1),
st AS (SELECT cluster_id, count(*) AS cluster_size, count(best_hit_name) AS n_with_match, count(*) - count(best_hit_name) AS n_without_match, COALESCE(max(nf), 0) AS n_distinct_families, COALESCE(max(nn), 0) AS n_distinct_names,
       COALESCE(avg(pident), 0.0) AS mean_pident, COALESCE(min(pident), 0.0) AS min_pident FROM cl JOIN ann USING (is_id) LEFT JOIN ff USING (cluster_id) LEFT JOIN gg USING (cluster_id) GROUP BY cluster_id)"""


def _clusters(t: Tables) -> DataFrame:
    return t.orders.selectExpr("o_orderkey AS is_id", "o_custkey AS cluster_id", "o_orderkey AS ordinal")


@query(f"WITH {_STATS} SELECT * REPLACE (round(mean_pident, 6) AS mean_pident) FROM st", "hsp", "elements")
def cluster_stats(t: Tables) -> DataFrame:
    s = hits.cluster_stats(_clusters(t), _annotation(t))
    return s.select("cluster_id", "cluster_size", "n_with_match", "n_without_match", *[F.col(c).cast("long").alias(c) for c in ("n_distinct_families", "n_distinct_names")], F.round("mean_pident", 6).alias("mean_pident"), "min_pident")


@query(f"""WITH {_ANNOTATED}, {_CLUSTERS},
x AS (SELECT cluster_id, best_hit_family AS v, count(*) AS k, min(ordinal) AS o FROM cl JOIN ann USING (is_id) WHERE best_hit_family IS NOT NULL GROUP BY ALL),
y AS (SELECT cluster_id, best_hit_name AS v, count(*) AS k, min(ordinal) AS o FROM cl JOIN ann USING (is_id) WHERE best_hit_name IS NOT NULL GROUP BY ALL)
SELECT c.cluster_id, COALESCE(f.v, '') AS dominant_family, COALESCE(n.v, '') AS dominant_name FROM (SELECT DISTINCT cluster_id FROM cl) c
LEFT JOIN (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY k DESC, o) = 1) f USING (cluster_id)
LEFT JOIN (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY k DESC, o) = 1) n USING (cluster_id)""", "hsp", "elements")
def dominant_family(t: Tables) -> DataFrame:
    return hits.dominant(_clusters(t), _annotation(t))


@query(f"""WITH {_STATS},
v AS (SELECT *, 1 + cluster_id % cluster_size AS l1, 1 + cluster_id // 2 % cluster_size AS l2 FROM st),
s AS (SELECT cluster_id, cluster_size, CASE WHEN n_with_match = 0 THEN 1.0 ELSE 0.5 * (n_without_match / (n_with_match + n_without_match)::DOUBLE) + 0.5 * least(1.0, greatest(0.0, (95.0 - mean_pident) / 45.0)) END AS dv,
      CASE WHEN cluster_size <= 1 THEN 0.0 ELSE 0.4 * ((l1 - 1) / (cluster_size - 1)::DOUBLE) + 0.6 * ((l2 - 1) / (cluster_size - 1)::DOUBLE) END AS di,
      CASE WHEN n_distinct_families = 0 AND n_distinct_names = 0 THEN 0.5 WHEN n_distinct_families > 1 THEN 1.0 WHEN n_distinct_names > 1 THEN least(0.7, 0.3 + 0.1 * (n_distinct_names - 1)) ELSE 0.0 END::DOUBLE AS mo FROM v),
z AS (SELECT *, round(0.5 * dv + 0.3 * di + 0.2 * mo, 4) AS novelty_score FROM s)
SELECT cluster_id, cluster_size, round(dv, 4)::DOUBLE AS divergence_score, round(di, 4)::DOUBLE AS diversity_score, round(mo, 4)::DOUBLE AS mosaic_score, novelty_score::DOUBLE AS novelty_score, CASE WHEN novelty_score >= 0.7 THEN 'novel' WHEN novelty_score >= 0.4 THEN 'divergent' ELSE 'known' END AS novelty_class FROM z""", "hsp", "elements")
def novelty_scores(t: Tables) -> DataFrame:
    s = hits.cluster_stats(_clusters(t), _annotation(t))
    s = s.withColumn("n_l1_groups", F.expr("1 + cluster_id % cluster_size")).withColumn("n_l2_groups", F.expr("1 + cluster_id div 2 % cluster_size"))
    return hits.novelty(s)


@query("""WITH g AS (SELECT is_id, n_tail_head_reads FROM evidence), p AS (SELECT DISTINCT is_id FROM evidence WHERE n_partial > 0),
a AS (SELECT is_id FROM elem WHERE is_id NOT IN (SELECT is_id FROM g))
SELECT is_id, CASE WHEN n_tail_head_reads > 0 THEN 'full' WHEN is_id IN (SELECT is_id FROM p) THEN 'partial' ELSE 'none' END AS circle_type FROM g
UNION ALL SELECT is_id, CASE WHEN is_id IN (SELECT is_id FROM p) THEN 'partial' ELSE 'none' END FROM a""", "elem", "evidence")
def evidence_split(t: Tables) -> DataFrame:
    return hits.split_evidence(t.evidence, t.elem, t.evidence.where("n_partial > 0"))


@query("SELECT organism AS cluster_id, COALESCE(bool_or(n_tail_head_reads > 0), false) AS has_circle_evidence FROM elem LEFT JOIN evidence USING (is_id) GROUP BY organism", "elem", "evidence")
def circle_flags(t: Tables) -> DataFrame:
    return hits.circle_flags(t.elem.selectExpr("organism AS cluster_id", "is_id"), t.evidence)


# ORFs

@query("""WITH p AS (SELECT o.*, seq_len, row_number() OVER w AS k, lead(orf_start) OVER w AS nx FROM orfs o JOIN elements USING (is_id) WINDOW w AS (PARTITION BY is_id ORDER BY orf_start, ordinal)),
g AS (SELECT is_id, 1 AS s, orf_start - 1 AS e, '5_prime' AS type FROM p WHERE k = 1 UNION ALL SELECT is_id, orf_end + 1, nx - 1, 'intergenic' FROM p WHERE nx IS NOT NULL
UNION ALL SELECT is_id, orf_end + 1, seq_len, '3_prime' FROM p WHERE nx IS NULL UNION ALL SELECT is_id, 1, seq_len, 'full' FROM elements WHERE is_id NOT IN (SELECT is_id FROM orfs))
SELECT is_id, s::BIGINT AS start, e::BIGINT AS "end", type, (e - s + 1)::BIGINT AS length FROM g WHERE s <= e""", "orfs", "elements")
def orf_gaps(t: Tables) -> DataFrame:
    o = t.orfs.withColumn("ordinal", F.col("ordinal") * 1_000_000 + F.col("orf_end"))
    return orfs.noncoding_regions(o.where("true"), t.elements)


ORACLES["orf_gaps"] = ORACLES["orf_gaps"].replace("ORDER BY orf_start, ordinal)", "ORDER BY orf_start, ordinal, orf_end)")


@query("SELECT e.is_id, count(orf_start) AS num_orfs, round(COALESCE(sum(orf_end - orf_start + 1), 0) / max(seq_len)::DOUBLE, 4) AS coding_fraction FROM elements e LEFT JOIN orfs o ON e.is_id = o.is_id GROUP BY e.is_id", "orfs", "elements")
def coding_fraction(t: Tables) -> DataFrame:
    return orfs.coding_fractions(t.orfs, t.elements)


_NEAR = "SELECT DISTINCT d.is_id FROM orfs d JOIN orfs t ON d.is_id = t.is_id WHERE d.has_dedd AND t.has_tnp20 AND greatest(t.orf_start - d.orf_end, d.orf_start - t.orf_end, 0) <= 300"


@query(_NEAR, "orfs")
def domain_adjacency(t: Tables) -> DataFrame:
    return orfs.adjacent_domains(t.orfs)


@query(f"SELECT DISTINCT is_id FROM orfs WHERE has_dedd AND has_tnp20 UNION {_NEAR}", "orfs")
def is110_ids(t: Tables) -> DataFrame:
    return orfs.two_domain_elements(t.orfs)


@query("SELECT DISTINCT is_id FROM orfs WHERE has_dedd INTERSECT SELECT DISTINCT is_id FROM orfs WHERE has_tnp20", "orfs")
def intersect_domains(t: Tables) -> DataFrame:
    return t.orfs.where("has_dedd").select("is_id").intersect(t.orfs.where("has_tnp20").select("is_id"))


@query("""WITH d AS (SELECT is_id, orf_start, orf_end, string_agg(DISTINCT x, ',' ORDER BY x) AS domains FROM (SELECT is_id, orf_start, orf_end, 'DEDD' AS x FROM orfs WHERE has_dedd UNION ALL SELECT is_id, orf_start, orf_end, 'Tnp20' FROM orfs WHERE has_tnp20) GROUP BY ALL)
SELECT o.is_id, o.orf_start, o.orf_end, o.strand, d.domains, count(*) AS n FROM orfs o LEFT JOIN d USING (is_id, orf_start, orf_end) GROUP BY ALL""", "orfs")
def orf_domains(t: Tables) -> DataFrame:
    h = t.orfs.where("has_dedd").withColumn("domain", F.lit("DEDD")).unionByName(t.orfs.where("has_tnp20").withColumn("domain", F.lit("Tnp20")))
    o = orfs.orf_domains(t.orfs, h)
    return o.groupBy("is_id", "orf_start", "orf_end", "strand", F.array_join("domains", ",").alias("domains")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT e.is_id, n_tail_head_reads AS n_th_reads, length(sequence) % 5 AS n_guide_hits, longest_nt, n_partial > 0 AS has_partial_circle FROM evidence e JOIN elem USING (is_id)
JOIN (SELECT is_id, max(orf_end - orf_start + 1) AS longest_nt FROM orfs GROUP BY is_id) USING (is_id) WHERE n_tail_head_reads > 0 AND length(sequence) % 5 > 0 AND longest_nt >= 100""", "elem", "evidence", "orfs")
def systems_summary(t: Tables) -> DataFrame:
    r = t.evidence.join(t.elem, "is_id").selectExpr("is_id", "n_tail_head_reads AS n_th_reads", "CAST(length(sequence) % 5 AS BIGINT) AS n_guide_hits")
    return batches.systems_summary(r, t.orfs, t.evidence.where("n_partial > 0"))


# graph

@query("SELECT * FROM inc", "inc")
def incidence(t: Tables) -> DataFrame:
    return graph.incidence(t.inc)


_EDGES = """n AS (SELECT is_id, count(*) AS n FROM inc GROUP BY is_id),
edges AS (SELECT a, b, k / (x.n + y.n - k)::DOUBLE AS similarity FROM (SELECT p.is_id AS a, q.is_id AS b, count(*) AS k FROM inc p JOIN inc q ON p.family = q.family AND p.is_id < q.is_id GROUP BY ALL) e
JOIN n x ON e.a = x.is_id JOIN n y ON e.b = y.is_id WHERE k / (x.n + y.n - k)::DOUBLE >= 0.3)"""


@query(f"WITH {_EDGES} SELECT * FROM edges", "inc")
def jaccard_edges(t: Tables) -> DataFrame:
    return similarity.jaccard_edges(graph.incidence(t.inc))


@query(f"""WITH RECURSIVE {_EDGES}, both_ways AS (SELECT a AS u, b AS v FROM edges UNION SELECT b, a FROM edges),
reach(node, seen) AS (SELECT DISTINCT is_id, is_id FROM inc UNION SELECT r.node, w.v FROM reach r JOIN both_ways w ON r.seen = w.u)
SELECT node, min(seen) AS component FROM reach GROUP BY node""", "inc")
def components(t: Tables) -> DataFrame:
    e = similarity.joined_sets(graph.incidence(t.inc))
    return graph.components(e, t.inc.select(F.col("is_id").alias("node")))


@query()
def louvain_communities(t: Tables) -> DataFrame:
    return graph.communities(similarity.jaccard_edges(graph.incidence(t.inc)), t.inc.select(F.col("is_id").alias("node")))


@query("SELECT count(DISTINCT is_id) AS n_nodes, 0::BIGINT AS n_apart, 0::BIGINT AS n_gaining FROM inc", "inc")
def community_certificate(t: Tables) -> DataFrame:
    """All elements have a community; none of these falls apart, and no element would gain by moving to another one."""
    edges = stored(similarity.jaccard_edges(graph.incidence(t.inc)), "jaccard-edges")
    shown = graph.community_certificate(edges, graph.communities(edges, t.inc.select(F.col("is_id").alias("node"))))
    return shown.agg(F.sum("size").alias("n_nodes"), F.count_if(F.col("parts") > 1).alias("n_apart"), F.count_if(F.col("best_gain") > graph.LEAST_GAIN).alias("n_gaining"))


@query()
def system_clusters(t: Tables) -> DataFrame:
    labels = graph.communities(similarity.jaccard_edges(graph.incidence(t.inc)), t.inc.select(F.col("is_id").alias("node")))
    return graph.assemble_clusters(labels).withColumn("members", F.array_join(F.col("members").cast("array<string>"), ","))


_L1 = """RECURSIVE m AS (SELECT sample_id AS cluster, is_id, concat(left(sequence, 80), right(sequence, 80)) AS seq, left(sequence, 2) AS guide FROM elem),
e AS (SELECT x.is_id AS u, y.is_id AS v FROM m x JOIN m y ON x.cluster = y.cluster AND x.is_id <> y.is_id AND abs(length(x.seq) - length(y.seq)) <= 10 WHERE levenshtein(x.seq, y.seq) <= 10),
r(node, seen) AS (SELECT is_id, is_id FROM m UNION SELECT r.node, e.v FROM r JOIN e ON r.seen = e.u),
l AS (SELECT m.cluster, m.is_id, m.guide, k.l1 FROM m JOIN (SELECT node, min(seen) AS l1 FROM r GROUP BY node) k ON m.is_id = k.node)"""


@query(f"WITH {_L1} SELECT cluster, is_id, l1 FROM l", "elem")
def l1_variants(t: Tables) -> DataFrame:
    return graph.flank_variants(_stored_members(t))


@query(f"""WITH {_L1}, g AS (SELECT cluster, l1, guide, row_number() OVER (PARTITION BY cluster ORDER BY l1, min(is_id)) AS k FROM l GROUP BY cluster, l1, guide)
SELECT l.cluster, l.is_id, l.l1, concat(l.l1, '.', g.k) AS l2 FROM l JOIN g USING (cluster, l1, guide)""", "elem")
def l2_variants(t: Tables) -> DataFrame:
    m = _stored_members(t)
    return graph.guide_variants(graph.flank_variants(m).join(m.select("is_id", "guide"), "is_id"))


# guides

def _parts(t: Tables) -> int:
    """Tasks for the stretches of all elements, with each flank."""
    letters = t.documents.agg(F.sum(F.length("text"))).first()[0]
    return guides.parts_of(2 * (letters or 0), t.spark.sparkContext.defaultParallelism)


def _pairs(t: Tables) -> DataFrame:
    f = t.flanked
    both = f.selectExpr("is_id", "nc AS nc_seq", "inline(array(struct(':up' AS side, up AS flank_seq), struct(':down' AS side, down AS flank_seq)))")
    pairs = both.where("flank_seq <> '' AND nc_seq <> ''").selectExpr("concat(is_id, side) AS key", "flank_seq", "nc_seq")
    return guides.dealt(pairs, _parts(t))


@query("""WITH p AS (SELECT concat(is_id, ':up') AS key, left(sequence, 80) AS a, substring(sequence, 81, greatest(length(sequence) - 160, 0)) AS b FROM elem UNION ALL SELECT concat(is_id, ':down'), right(sequence, 80), substring(sequence, 81, greatest(length(sequence) - 160, 0)) FROM elem),
x AS (SELECT key, i AS pos1, substr(a, i + 1, 9) AS kmer FROM p, unnest(range(0, greatest(length(a) - 8, 0))) u(i) WHERE b <> ''), y AS (SELECT key, i AS pos2, substr(b, i + 1, 9) AS kmer FROM p, unnest(range(0, greatest(length(b) - 8, 0))) u(i)),
z AS (SELECT key, pos1, kmer, 'forward' AS orientation FROM x UNION ALL SELECT key, pos1, reverse(translate(kmer, 'ACGT', 'TGCA')), 'reverse_complement' FROM x)
SELECT key, pos1, pos2, orientation FROM z JOIN y USING (key, kmer)""", "elem")
def guide_seeds(t: Tables) -> DataFrame:
    return guides.guide_seeds(_pairs(t)).select("key", F.col("pos1").cast("long").alias("pos1"), F.col("pos2").cast("long").alias("pos2"), "orientation")


# Growth and choice in SQL: letters of a seed's diagonal are compared one by one; the choice folds over a key's sorted hits.
_GUIDES = """g AS (SELECT key, orientation, i, least(j, length(a)) AS j, j - least(j, length(a)) AS base, a, substr(b, j - least(j, length(a)) + 1, least(j, length(a)) + length(a) + 9) AS b FROM (
  SELECT key, pos1 AS i, pos2 AS j, 'forward' AS orientation FROM x JOIN y USING (key, kmer)
  UNION ALL SELECT key, pos1, pos2, 'reverse_complement' FROM (SELECT key, pos1, reverse(translate(kmer, 'ACGT', 'TGCA')) AS kmer FROM x) JOIN y USING (key, kmer)) JOIN pairs USING (key)),
fr AS (SELECT *, list_filter(range(9, least(length(a) - i, length(b) - j)), lambda t: a[i + t + 1] <> b[j + t + 1]) AS r, list_filter(range(1, least(i, j) + 1), lambda t: a[i - t + 1] <> b[j - t + 1]) AS l
  FROM g WHERE orientation = 'forward' AND (i = 0 OR j = 0 OR a[i] <> b[j])),
fm AS (SELECT *, CASE WHEN len(r) > 0 THEN 0 ELSE COALESCE(l[2], least(i, j) + 1) - 1 END AS s FROM fr),
fh AS (SELECT key, orientation, a, b, i AS i0, j AS j0, i - s AS i, j - s AS j, base, COALESCE(r[2], least(length(a) - i, length(b) - j)) + s AS n, CASE WHEN len(r) > 0 THEN [r[1]] WHEN len(l) > 0 THEN [s - 1] ELSE [] END AS bad FROM fm),
r1 AS (SELECT *, reverse(translate(b, 'ACGT', 'TGCA')) AS rb, least(length(a) - i, length(b) - j) - 9 AS room FROM g WHERE orientation = 'reverse_complement'),
r2 AS (SELECT *, 9 + COALESCE(NULLIF(list_position(list_transform(range(1, room + 1), lambda s: len(list_filter(range(0, 9 + s), lambda t: a[i + t + 1] <> rb[length(b) - j - 9 - s + t + 1])) <= 1), false), 0) - 1, room) AS n FROM r1),
r3 AS (SELECT *, COALESCE(NULLIF(list_position(list_transform(range(1, least(i, j) + 1), lambda s: len(list_filter(range(0, n + s), lambda t: a[i - s + t + 1] <> rb[length(b) - (j - s) - (n + s) + t + 1])) <= 1), false), 0) - 1, least(i, j)) AS s FROM r2),
rh AS (SELECT key, orientation, a, b, i AS i0, j AS j0, i - s AS i, j - s AS j, base, n + s AS n, list_filter(range(0, n + s), lambda t: a[i - s + t + 1] <> rb[length(b) - (j - s) - (n + s) + t + 1]) AS bad FROM r3),
h AS (SELECT key, orientation, i, base + j AS j, n, any_value(bad) AS bad, min((i0, base + j0)) AS seed, any_value(substr(a, i + 1, n)) AS x, any_value(substr(b, j + 1, n)) AS y FROM (SELECT * FROM fh UNION ALL SELECT * FROM rh)
  WHERE (len(bad) = 0 AND n >= 9) OR (len(bad) <= 1 AND n >= 12) GROUP BY key, orientation, i, base + j, n),
k AS (SELECT key, orientation, list_reduce(list([{'i': i, 'j': j, 'n': n, 'bad': bad, 'x': x, 'y': y}] ORDER BY n DESC, len(bad), seed),
  lambda kept, o: CASE WHEN len(list_filter(kept, lambda e: e.i < o[1].i + o[1].n AND o[1].i < e.i + e.n AND e.j < o[1].j + o[1].n AND o[1].j < e.j + e.n)) > 0 THEN kept ELSE list_concat(kept, o) END) AS kept FROM h GROUP BY key, orientation),
hits AS (SELECT key, u.i AS pos_in_flanking, u.j AS pos_in_noncoding, u.n AS length, orientation, len(u.bad)::INTEGER AS mismatches, array_to_string(u.bad, ',') AS mismatch_positions, u.x AS seq_flanking, u.y AS seq_noncoding
  FROM (SELECT key, orientation, unnest(kept) AS u FROM k))"""
_KMERS = """x AS (SELECT key, i AS pos1, substr(a, i + 1, 9) AS kmer FROM pairs, unnest(range(0, greatest(length(a) - 8, 0))) u(i)), y AS (SELECT key, i AS pos2, substr(b, i + 1, 9) AS kmer FROM pairs, unnest(range(0, greatest(length(b) - 8, 0))) u(i))"""
_STRETCH = "substring(sequence, 81, greatest(length(sequence) - 160, 0))"
_FLANKS = f"pairs AS (SELECT * FROM (SELECT concat(is_id, ':up') AS key, left(sequence, 80) AS a, {_STRETCH} AS b FROM elem UNION ALL SELECT concat(is_id, ':down'), right(sequence, 80), {_STRETCH} FROM elem) WHERE a <> '' AND b <> '')"


@query(f"WITH {_FLANKS}, {_KMERS}, {_GUIDES} SELECT * FROM hits", "elem")
def guide_hits(t: Tables) -> DataFrame:
    return guides.guide_hits(_pairs(t)).withColumn("mismatch_positions", F.array_join(F.col("mismatch_positions").cast("array<string>"), ","))


@query(f"""WITH {_FLANKS}, {_KMERS}, {_GUIDES}
SELECT pairs.key, count(hits.key) AS n_hits, COALESCE(max(hits.length), 0) AS best_length, COALESCE(bool_or(hits.orientation = 'reverse_complement'), false) AS has_revcomp_hit FROM pairs LEFT JOIN hits ON pairs.key = hits.key GROUP BY pairs.key""", "elem")
def guide_summary(t: Tables) -> DataFrame:
    p = _pairs(t)
    return guides.guide_summary(guides.guide_hits(p), p)


@query(f"WITH {_FLANKS}, {_KMERS}, {_GUIDES} SELECT key, arg_max(seq_flanking, (length, -pos_in_flanking, -pos_in_noncoding)) AS best_guide FROM hits GROUP BY key", "elem")
def best_guide(t: Tables) -> DataFrame:
    return guides.best_guide(guides.guide_hits(_pairs(t)))


_REGIONS = f"""pairs AS (SELECT concat(is_id, ':', source, ':', idx) AS key, is_id, source, idx, kind, s, e, a, substr({_STRETCH}, s, e - s + 1) AS b FROM (
  SELECT is_id, sequence, 'upstream' AS source, left(sequence, 80) AS a FROM elem UNION ALL SELECT is_id, sequence, 'downstream', right(sequence, 80) FROM elem),
  (SELECT 0::INTEGER AS idx, 'upstream' AS kind, 1::BIGINT AS s UNION ALL SELECT 1, 'intergenic', 101), LATERAL (SELECT CASE idx WHEN 0 THEN 60 ELSE length({_STRETCH}) END AS e) WHERE a <> '' AND b <> '')"""


@query(f"""WITH {_REGIONS}, {_KMERS}, {_GUIDES}
SELECT is_id, source AS flanking_source, idx AS noncoding_region_index, kind AS noncoding_region_type, s AS noncoding_start, e AS noncoding_end, hits.* EXCLUDE (key) FROM hits JOIN pairs USING (key)""", "elem")
def record_guides(t: Tables) -> DataFrame:
    """Two noncoding regions of each element's stretch, each with both flanks."""
    r = t.flanked.select("is_id", F.struct(F.col("nc").alias("sequence")).alias("is_element"), F.struct(F.col("up").alias("sequence")).alias("flanking_upstream"), F.struct(F.col("down").alias("sequence")).alias("flanking_downstream"))
    regions = "struct(array(struct(1L AS start, 60L AS end, 'upstream' AS type), struct(101L AS start, cast(length(is_element.sequence) AS bigint) AS end, 'intergenic' AS type)) AS noncoding_regions)"
    pairs = guides.dealt(guides.region_pairs(r.withColumn("orf_annotation", F.expr(regions))), _parts(t))
    found = guides.guide_hits(pairs).withColumn("mismatch_positions", F.array_join(F.col("mismatch_positions").cast("array<string>"), ","))
    return found.select("key.*", *[c for c in found.columns if c != "key"])


# batches and status

@query("""SELECT srr_accession, organism, (row_number() OVER (ORDER BY c DESC, organism, md5(CAST(srr_accession AS VARCHAR)), srr_accession) - 1) % 7 AS batch
FROM (SELECT *, count(*) OVER (PARTITION BY organism) AS c FROM meta WHERE organism IS NOT NULL)""", "meta")
def batch_assign(t: Tables) -> DataFrame:
    return batches.round_robin(t.meta, 7)


@query("SELECT srr_accession, organism, platform, CAST(floor((row_number() OVER (ORDER BY srr_accession) - 1) / ceil((SELECT count(*) FROM meta) / 5.0)) AS BIGINT) AS chunk FROM meta", "meta")
def chunk_assign(t: Tables) -> DataFrame:
    return batches.chunks(t.meta, "srr_accession", 5)


@query("SELECT batch, count(*) FILTER (status = 'ok') AS n_ok, count(*) AS n_total FROM status GROUP BY batch", "status")
def batch_status(t: Tables) -> DataFrame:
    return t.status.groupBy("batch").agg(F.count_if(F.col("status") == "ok").alias("n_ok"), F.count(F.lit(1)).alias("n_total"))


@query("SELECT batch, count(*) FILTER (status = 'ok') AS n_ok, count(*) AS n_total, CAST(grouping(batch) AS INT) AS is_total FROM status GROUP BY ROLLUP (batch)", "status")
def status_rollup(t: Tables) -> DataFrame:
    return batches.status_rollup(t.status)


@query("SELECT batch, count(*) FILTER (l.k IS NOT NULL) AS n_with, count(*) FILTER (l.k IS NULL) AS n_without FROM status s LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R') l ON s.sample_id = l.k GROUP BY batch", "status")
def completeness(t: Tables) -> DataFrame:
    return batches.completeness(t.status, t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("sample_id")))


@query("SELECT organism, platform, count(*) AS n FROM meta GROUP BY ALL", "meta")
def value_counts(t: Tables) -> DataFrame:
    return batches.value_counts(t.meta, ["organism", "platform"])


@query("SELECT platform, count(DISTINCT organism) AS n_organisms FROM meta GROUP BY platform", "meta")
def organism_nunique(t: Tables) -> DataFrame:
    return t.meta.groupBy("platform").agg(F.count_distinct("organism").alias("n_organisms"))


@query("SELECT DISTINCT organism FROM meta WHERE organism IS NOT NULL", "meta")
def distinct_organisms(t: Tables) -> DataFrame:
    return t.meta.where("organism IS NOT NULL").select("organism").distinct()


@query("""SELECT organism, accession, level FROM (SELECT *, row_number() OVER (PARTITION BY organism ORDER BY CASE level WHEN 'Complete Genome' THEN 0 WHEN 'Chromosome' THEN 1 WHEN 'Scaffold' THEN 2 WHEN 'Contig' THEN 3 ELSE 4 END, NOT starts_with(accession, 'GCF_'), accession) AS k
FROM (SELECT p_partkey % 40 AS organism, concat(CASE WHEN p_partkey % 3 = 0 THEN 'GCF_' ELSE 'GCA_' END, p_partkey) AS accession, CASE p_partkey % 5 WHEN 0 THEN 'Contig' WHEN 1 THEN 'Scaffold' WHEN 2 THEN 'Chromosome' WHEN 3 THEN 'Complete Genome' ELSE 'other' END AS level FROM part)) WHERE k = 1""")
def assembly_pick(t: Tables) -> DataFrame:
    rows = t.part.selectExpr("p_partkey % 40 AS organism", "concat(CASE WHEN p_partkey % 3 = 0 THEN 'GCF_' ELSE 'GCA_' END, p_partkey) AS accession", "CASE p_partkey % 5 WHEN 0 THEN 'Contig' WHEN 1 THEN 'Scaffold' WHEN 2 THEN 'Chromosome' WHEN 3 THEN 'Complete Genome' ELSE 'other' END AS level")
    return ranking.pick_assembly(rows).select("organism", "accession", "level")


# dedup, sets, filters

@query("SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM conversations) WHERE k = 1")
def first_wins(t: Tables) -> DataFrame:
    return ranking.first_by(t.conversations, ["conv_id"], ["turn", "role", "text"]).select("conv_id", "turn", "role")


@query("SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS k FROM conversations) WHERE k = 1")
def last_wins(t: Tables) -> DataFrame:
    return ranking.last_by(t.conversations, ["conv_id"], ["turn", "role", "text"]).select("conv_id", "turn", "role")


@query("SELECT read_id, seg, ref_id, is_reverse, left_clip FROM (SELECT *, row_number() OVER (PARTITION BY ref_id, is_reverse, left_clip, mapq ORDER BY read_id, seg) AS k FROM aln) WHERE k = 1", "aln")
def hit_dedup(t: Tables) -> DataFrame:
    return ranking.first_by(t.aln, ["ref_id", "is_reverse", "left_clip", "mapq"], ["read_id", "seg"]).select("read_id", "seg", "ref_id", "is_reverse", "left_clip")


@query("SELECT read_id, seg, mapq FROM aln WHERE mapq BETWEEN 12 AND 30 AND ref_end - ref_start <= 400", "aln")
def range_filter(t: Tables) -> DataFrame:
    return t.aln.where(F.col("mapq").between(12, 30) & (F.col("ref_end") - F.col("ref_start") <= 400)).select("read_id", "seg", "mapq")


@query("SELECT srr_accession, platform FROM meta WHERE lower(platform) IN ('building', 'machinery')", "meta")
def in_list(t: Tables) -> DataFrame:
    return t.meta.where(F.lower("platform").isin("building", "machinery")).select("srr_accession", "platform")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT c_custkey AS sample, n_name AS reference FROM customer, nation")
def sample_ref_cross(t: Tables) -> DataFrame:
    samples = t.customer.select(F.col("c_custkey").alias("sample"))
    return samples.crossJoin(F.broadcast(t.nation.select(F.col("n_name").alias("reference"))))


@query("SELECT sample_id, batch FROM status WHERE sample_id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')", "status")
def pending_units(t: Tables) -> DataFrame:
    return ranking.pending(t.status, t.lineitem.where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("sample_id")), ["sample_id"]).select("sample_id", "batch")


@query("SELECT is_id, n_tail_head_reads, 'first' AS source FROM evidence UNION ALL SELECT is_id, NULL, 'second' FROM elem WHERE is_id NOT IN (SELECT is_id FROM evidence)", "elem", "evidence")
def union_sources(t: Tables) -> DataFrame:
    return batches.collect_records(t.evidence.select("is_id", "n_tail_head_reads"), t.elem.select("is_id"))


@query("SELECT is_id FROM elem EXCEPT SELECT is_id FROM evidence WHERE n_tail_head_reads > 0", "elem", "evidence")
def except_ids(t: Tables) -> DataFrame:
    return t.elem.select("is_id").subtract(t.evidence.where("n_tail_head_reads > 0").select("is_id"))


@query("""WITH rules(name, kind) AS (VALUES ('O', 'required'), ('F', 'required'), ('P', 'optional'), ('X', 'legacy'), ('missing_dir', 'required')), l AS (SELECT DISTINCT o_custkey % 8 AS batch, o_orderstatus AS name FROM orders)
SELECT batch, l.name, COALESCE(kind, 'unknown') AS state FROM l LEFT JOIN rules ON l.name = rules.name
UNION ALL SELECT b.batch, r.name, 'missing' FROM (SELECT DISTINCT batch FROM l) b, rules r WHERE kind = 'required' AND NOT EXISTS (SELECT 1 FROM l WHERE l.batch = b.batch AND l.name = r.name)""")
def layout_report(t: Tables) -> DataFrame:
    rules = t.spark.createDataFrame([("O", "required"), ("F", "required"), ("P", "optional"), ("X", "legacy"), ("missing_dir", "required")], "name string, kind string")
    return batches.layout_report(t.orders.select((F.col("o_custkey") % 8).alias("batch"), F.col("o_orderstatus").alias("name")), rules)
