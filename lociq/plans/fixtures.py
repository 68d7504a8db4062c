"""Views that give the driver's tables the shape of the domain's tables, for Spark and (as SQL text) for the oracle."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

_ALN = """
SELECT l_orderkey AS read_id,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS seg,
       l_suppkey % 10 AS ref_id, l_linenumber * 200 AS query_start,
       CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS ref_start,
       CAST(floor(l_extendedprice) AS BIGINT) % 1000 + 40 + CAST(round(l_quantity) AS BIGINT) * 12 AS ref_end,
       l_returnflag = 'R' AS is_reverse, CAST(l_partkey % 61 AS INT) AS mapq,
       CAST(round(l_discount * 100) AS BIGINT) * 40 AS left_clip, CAST(round(l_tax * 100) AS BIGINT) * 40 AS right_clip
FROM {lineitem}"""
_ELEM = """
SELECT doc_id AS is_id, source AS sample_id, lang AS organism,
       translate(regexp_replace(lower(text), '[^a-z]', ''{g}), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS sequence
FROM {documents}"""
_META = "SELECT c_custkey AS srr_accession, n_name AS organism, c_mktsegment AS platform FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"
_INC = "SELECT DISTINCT o_custkey AS is_id, l_suppkey AS family FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey"
_HSP = """
SELECT l_orderkey AS qseqid, l_suppkey % 10 AS sseqid, 80.0E0 + l_partkey % 20 AS pident, l_linenumber * 120 AS qstart,
       l_linenumber * 120 + CAST(round(l_quantity) AS BIGINT) * 10 AS qend, CAST(floor(l_extendedprice) AS BIGINT) AS sstart,
       CAST(floor(l_extendedprice) AS BIGINT) + CAST(round(l_quantity) AS BIGINT) * 10 AS send, l_extendedprice AS bitscore, 840 AS qlen,
       concat('E', CAST(l_partkey % 30 AS VARCHAR(10))) AS hit_name, concat('G', CAST(l_partkey % 7 AS VARCHAR(10))) AS hit_group, l_partkey AS ordinal
FROM {lineitem}"""
_ORFS = """
SELECT l_orderkey AS is_id, l_linenumber * 300 - 250 + l_partkey % 50 AS orf_start,
       l_linenumber * 300 - 250 + l_partkey % 50 + CAST(round(l_quantity) AS BIGINT) * 5 AS orf_end, CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS strand,
       l_suppkey % 3 = 0 AS has_dedd, l_partkey % 3 = 0 AS has_tnp20, l_partkey AS ordinal, l_suppkey AS ordinal2
FROM {lineitem}"""
_BLOCKS = """
SELECT read_id AS pair_id, seg, seg * 200 AS core_start, seg * 200 + 150 AS core_end, seg * 200 + (mapq % 4) * 120 AS host_start, seg * 200 + (mapq % 4) * 120 + 150 AS host_end
FROM {aln}"""
_STATUS = "SELECT o_orderkey AS sample_id, o_custkey % 8 AS batch, CASE WHEN o_orderstatus = 'F' THEN 'ok' ELSE 'failed' END AS status FROM {orders}"
_EVIDENCE = "SELECT doc_id AS is_id, quality AS n_tail_head_reads, toxic AS n_partial FROM {labels}"
_TARGETS = "SELECT DISTINCT s_suppkey % 10 AS ref_id, concat('e', CAST(s_suppkey % 10 AS VARCHAR(10))) AS uuid, 500 AS n FROM {supplier}"
_ELEMENTS = "SELECT o_orderkey AS is_id, 2399 AS seq_len FROM {orders}"
#: name: (SQL, names it reads)
VIEWS = {
    "aln": (_ALN, ["lineitem"]), "elem": (_ELEM, ["documents"]), "meta": (_META, ["customer", "nation"]), "inc": (_INC, ["orders", "lineitem"]), "hsp": (_HSP, ["lineitem"]), "orfs": (_ORFS, ["lineitem"]),
    "blocks": (_BLOCKS, ["aln"]), "status": (_STATUS, ["orders"]), "evidence": (_EVIDENCE, ["labels"]), "targets": (_TARGETS, ["supplier"]), "elements": (_ELEMENTS, ["orders"]),
}


def oracle(body: str, *views: str) -> str:
    """SQL for the oracle: the views a query needs as common table expressions, then its body."""
    need: list[str] = []
    for v in views:
        need += [x for x in VIEWS[v][1] if x in VIEWS and x not in need] + [v] * (v not in need)
    parts = [f"{v} AS ({VIEWS[v][0].format(g=', ' + chr(39) + 'g' + chr(39), **{n: n for n in VIEWS[v][1]})})" for v in need]
    body = body.strip()
    recursive = body.upper().startswith("WITH RECURSIVE")
    head = "WITH RECURSIVE" if recursive else "WITH"
    if body.upper().startswith("WITH"):
        return f"{head} {', '.join(parts)}, {body[len(head):].strip()}" if parts else body
    return f"{head} {', '.join(parts)} {body}" if parts else body


class Tables:
    """The driver's tables and the views over them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in VIEWS:
            sql, reads = VIEWS[name]
            return self.spark.sql(sql.replace("{g}", ""), **{r: getattr(self, r) for r in reads})
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def flanked(self) -> DataFrame:
        """Elements with two flanks of 80 and all between them as the noncoding stretch."""
        return self.elem.selectExpr("is_id", "sample_id", "organism", "left(sequence, 80) AS up", "right(sequence, 80) AS down", "substring(sequence, 81, greatest(length(sequence) - 160, 0)) AS nc", "left(sequence, 2) AS guide")
