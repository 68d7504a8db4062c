"""Mixing sources to target weights by a low-discrepancy schedule.

Every source is a stream of words: its documents in a shuffled order (md5 of doc_id), cut into blocks of
`block_words` words and read cyclically. Slot n of the schedule holds the point frac(n * golden ratio), which cumulative
weights map to a source; the k-th slot of a source takes its k-th block. Slots beyond a source's target are
left out, and the few that rounding leaves missing follow at the end, so each source is met exactly.

No window spans a whole source: ranks and running sums have two levels, buckets first and then rows in a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociq.llm.common import join_checked, pick, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 256
MAX_EPOCHS = 3
#: floor(2**31 / golden ratio), odd; multiples modulo 2**31 run through all points.
_GOLDEN, _ONE = 1327217885, 1 << 31
_CELLS, _CHUNKS = 4096, 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: sid (rank by code point, null last), source_size, weight, target, quota (whole words), share bounds lo and hi.

    Targets share the sum of all sizes by weight; none exceeds max_epochs times its source's size, and what is above goes to
    the others by weight. Works on the aggregated table of sources only.
    """
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    t = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = t.withColumn("sid", F.row_number().over(by_name).cast("long") - 1)
    t = t.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int")))
    t = t.withColumn("most", F.col("source_size") * float(max_epochs)).withColumn("ratio", F.col("most") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", "sid")
    before = F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) - F.col("most")
    onward = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    t = t.withColumn("level", (F.sum(F.col("source_size").cast("double")).over(everything) - before) / onward)
    t = t.withColumn("level", F.max(F.when(F.col("ratio") >= F.col("level"), F.col("level"))).over(everything))
    t = t.withColumn("target", F.least(F.col("most"), F.coalesce(F.col("level") * F.col("weight"), F.lit(0.0))))
    t = t.withColumn("quota", F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * max_epochs).cast("long"))
    running = F.sum("target").over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("target").over(everything)
    t = t.withColumn("hi", F.coalesce(F.floor(running / F.nullif(total, F.lit(0.0)) * _ONE), F.lit(0)).cast("long"))
    t = t.withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("sid")), F.lit(0)))
    return t.select("sid", "source", "source_size", "weight", "target", "quota", "lo", "hi")


def shuffled_streams(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows of sized with sid, source_size, target, quota and `begin`, the row's first word in its source's shuffled stream."""
    rows = sized.withColumn("place", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).withColumn("bucket", F.substring("place", 1, 3))
    few = targets.select(F.col("source").alias("source_"), "sid", "source_size", "target", "quota")
    few = F.broadcast(few) if targets.count() <= 100_000 else few
    rows = rows.join(few, F.col("source").eqNullSafe(F.col("source_")), "inner").drop("source_")
    sums = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("in_bucket"))
    upto = F.sum("in_bucket").over(Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    sums = stored(sums.select("sid", "bucket", (upto - F.col("in_bucket")).alias("base")), "mix-buckets")
    rows = join_checked(rows, sums, ["sid", "bucket"])
    inside = Window.partitionBy("sid", "bucket").orderBy("place", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("doc_id", "source", "size", "sid", "source_size", "target", "quota", (F.col("base") + F.sum("size").over(inside) - F.col("size")).alias("begin"))


def slots(targets: DataFrame, total: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """slot, sid, block: the schedule. Every source has exactly the blocks 0 .. ceil(quota / block_words) - 1."""
    spark = targets.sparkSession
    n = -(-total // block_words)
    cell = _ONE // _CELLS
    grid = targets.where("hi > lo").withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / cell), F.floor((F.col("hi") - 1) / cell)))).select("sid", "quota", "lo", "hi", "cell")
    grid = stored(grid, "mix-grid")
    points = spark.range(n).withColumnRenamed("id", "slot").withColumn("point", (F.col("slot") % _ONE * _GOLDEN) % _ONE)
    points = points.withColumn("cell", F.floor(F.col("point") / cell))
    hit = join_checked(points, grid, "cell").where("point >= lo AND point < hi").select("slot", "sid", "quota")
    hit = hit.withColumn("chunk", F.floor(F.col("slot") / max(1, -(-n // _CHUNKS))))
    counts = hit.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0))
    counts = stored(counts.select("sid", "chunk", "n", (upto - F.col("n")).alias("base")), "mix-chunks")
    rank = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot"))
    planned = join_checked(hit, counts.drop("n"), ["sid", "chunk"]).withColumn("block", F.col("base") + rank - 1)
    need = F.ceil(F.col("quota") / block_words)
    planned = planned.where(F.col("block") < need).select("slot", "sid", "block")
    made = counts.groupBy("sid").agg(F.sum("n").alias("made"))
    short = targets.join(made, "sid", "left").select("sid", need.alias("need"), F.coalesce("made", F.lit(0)).alias("made")).where("made < need")
    closing = short.withColumn("block", F.explode(F.sequence("made", F.col("need") - 1)))
    return planned.unionByName(closing.select((F.lit(n) + F.col("block")).alias("slot"), "sid", "block"))


def pieces(streams: DataFrame, schedule: DataFrame, block_words: int = BLOCK_WORDS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix: for every slot, the documents' word ranges [first_word, last_word) that it holds, in order of `at`."""
    turns = streams.where("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
    turns = turns.withColumn("from", F.col("begin") + F.col("epoch") * F.col("source_size")).where(F.col("from") < F.col("quota"))
    turns = turns.withColumn("to", F.least(F.col("from") + F.col("size"), F.col("quota")))
    cut = turns.withColumn("block", F.explode(F.sequence(F.floor(F.col("from") / block_words), F.floor((F.col("to") - 1) / block_words))))
    cut = cut.withColumn("at", F.greatest(F.col("from"), F.col("block") * block_words)).withColumn("end", F.least(F.col("to"), (F.col("block") + 1) * block_words))
    cut = cut.select("sid", "block", "doc_id", "size", "begin", "at", (F.col("at") - F.col("from")).alias("first_word"), (F.col("end") - F.col("from")).alias("last_word"))
    return schedule.join(cut, ["sid", "block"])


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, block_words: int = BLOCK_WORDS, max_epochs: int = MAX_EPOCHS) -> tuple[DataFrame, DataFrame]:
    """(streams, pieces) of docs.

    Null texts and texts without words have size 0: they stay in streams and have no pieces. A null source is a source of
    its own, ranked last. Repeated rows are rows of their own. Empty tables give empty results. Other columns are ignored.
    """
    sized = stored(pick(docs, doc_id="long", source="string", text="string").select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    targets = stored(source_targets(sized, weights, max_epochs), "mix-targets")
    total = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    streams = stored(shuffled_streams(sized, targets), "mix-streams")
    return streams, pieces(streams, slots(targets, int(total), block_words), block_words, max_epochs)


def mixed_amounts(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, block_words: int = BLOCK_WORDS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row of docs."""
    streams, parts = mix(docs, weights, block_words, max_epochs)
    taken = parts.groupBy("sid", "begin", "size").agg(F.sum(F.col("last_word") - F.col("first_word")).alias("taken"))
    out = streams.join(taken, ["sid", "begin", "size"], "left")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, block_words: int = BLOCK_WORDS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Whole documents of the mix: each row of docs as often as its taken words fill it, rounded (only one document of a source is cut).

    Rows are matched to their amounts by doc_id, source and size, and rows that agree in all three one by one, so each amount is
    used once. The columns of docs are kept whatever their names are.
    """
    amounts = mixed_amounts(docs, weights, block_words, max_epochs).where("taken > 0")
    copies = amounts.select(*_match_keys(F.col("doc_id"), F.col("source"), F.col("size")), F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("copies"))
    copies = copies.withColumn("turn", F.row_number().over(Window.partitionBy(*_KEYS).orderBy(F.desc("copies")))).where("copies > 0")
    have = {c.lower(): c for c in docs.columns}
    get = lambda c, t: F.col("row").getField(have[c]).cast(t) if c in have else F.lit(None).cast(t)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", *_match_keys(get("doc_id", "long"), get("source", "string"), word_count(get("text", "string"))))
    rows = rows.where("match_size > 0").withColumn("turn", F.row_number().over(Window.partitionBy(*_KEYS).orderBy(F.xxhash64("row"))))
    return rows.join(copies, [*_KEYS, "turn"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


_KEYS = ("match_id", "match_no_id", "match_source", "match_no_source", "match_size")


def _match_keys(doc_id: Column, source: Column, size: Column) -> list[Column]:
    """doc_id, source and size as columns without nulls, so that one shuffle serves both the turns and the join."""
    return [F.coalesce(doc_id, F.lit(0)).alias(_KEYS[0]), doc_id.isNull().alias(_KEYS[1]), F.coalesce(source, F.lit("")).alias(_KEYS[2]), source.isNull().alias(_KEYS[3]), size.cast("long").alias(_KEYS[4])]


ORACLE = """
WITH s AS (SELECT doc_id, source, COALESCE(LEN(REGEXP_EXTRACT_ALL(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
g AS (SELECT source, SUM(size)::BIGINT AS source_size FROM s GROUP BY source),
w AS (SELECT *, CASE (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
      ROW_NUMBER() OVER (ORDER BY source NULLS LAST) AS sid, source_size * 3.0::DOUBLE AS most FROM g),
l AS (SELECT *, most / weight AS ratio, ((SELECT SUM(source_size::DOUBLE) FROM g) - (SUM(most) OVER (ORDER BY most / weight, sid ROWS UNBOUNDED PRECEDING) - most))
      / SUM(weight) OVER (ORDER BY most / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, sid, source_size, LEAST(most, COALESCE((SELECT MAX(level) FROM l WHERE ratio >= level) * weight, 0.0)) AS target FROM l),
p AS (SELECT s.doc_id, s.source, s.size, t.source_size, t.target, LEAST(FLOOR(t.target + 0.5), t.source_size * 3)::BIGINT AS quota,
      (SUM(s.size) OVER (PARTITION BY t.sid ORDER BY MD5(COALESCE(s.doc_id::VARCHAR, '')), s.doc_id NULLS FIRST, s.size ROWS UNBOUNDED PRECEDING) - s.size)::BIGINT AS b
      FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
       (GREATEST(0, LEAST(b + size, quota) - b) + GREATEST(0, LEAST(b + size + source_size, quota) - b - source_size)
        + GREATEST(0, LEAST(b + size + 2 * source_size, quota) - b - 2 * source_size))::BIGINT AS taken
FROM p
"""
