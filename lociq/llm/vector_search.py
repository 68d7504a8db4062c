"""Nearest vectors by score-aware (anisotropic) product quantisation.

A vector is x = c + s u: the nearest of a few anchors c, its distance s, and a direction u of length 1. Smallest Euclidean distance is
largest -|q - c|^2 / 2 + s (q - c).u - s^2 / 2, an inner product. Directions are cut into subspaces of two dimensions with
16 centroids each, so a code has four bits. Codebooks and codes minimise a loss that weighs the part of the residual
that is parallel to the direction more than the rest, as that part changes large inner products most; what the code leaves has a length and a
second code. So errors are shares of s: vectors of tight groups, of very different lengths or far from the origin keep their order. A scan adds
table entries, one for every byte of the codes; s is kept. The best `rerank` vectors of each query are compared exactly on the originals.

Equal vectors are indexed once, with their k + 1 smallest ids, so copies do not fill the candidate lists.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociq.llm.common import pick, small_batches, stored

#: Vectors that the codebooks are fitted on: those with the smallest hash of vec_id.
SAMPLE = 8000
#: Vectors reranked for each query in a table of RERANK_ROWS; the number grows with the fourth root of the table's rows.
RERANK, RERANK_ROWS = 500, 50_000
CENTROIDS, PART = 16, 2
#: Weighs parallel error as for scores above this share of the norms' product.
THRESHOLD = 0.2
QUERY_BLOCK, INDEX_BLOCK = 512, 4096
#: Anchors at most, and rounds that place them on the sample.
ANCHORS, ANCHOR_ROUNDS = 256, 8
#: Query blocks of a wave, which are sent to all tasks, at most, and bytes of its vectors, their tables and best candidates, which a task holds at a time.
OPEN_BLOCKS, WAVE_BYTES = 32, 256 << 20
#: Index blocks that a task scans, at least, where there are enough for all cores: it bounds the candidate lists that meet for a query.
PART_BLOCKS = 256


class Codebooks(NamedTuple):
    centers: np.ndarray  # (subspaces, 16, PART)
    weight: float  # of the parallel part, less that of the rest

    def encode(self, x: np.ndarray, sweeps: int = 2) -> np.ndarray:
        """Codes (rows, subspaces) by coordinate descent on the anisotropic loss."""
        parts = _parts(x, len(self.centers))
        norm = np.maximum((x**2).sum(axis=1), 1e-30)
        codes = np.stack([((parts[:, m, None, :] - c) ** 2).sum(axis=2).argmin(axis=1) for m, c in enumerate(self.centers)], axis=1)
        along = np.stack([((parts[:, m] - c[codes[:, m]]) * parts[:, m]).sum(axis=1) for m, c in enumerate(self.centers)], axis=1)
        total = along.sum(axis=1)
        for _ in range(sweeps):
            for m, c in enumerate(self.centers):
                rest = total - along[:, m]
                diff = parts[:, m, None, :] - c
                inner = (diff * parts[:, m, None, :]).sum(axis=2)
                loss = (diff**2).sum(axis=2) + self.weight * (rest[:, None] + inner) ** 2 / norm[:, None]
                codes[:, m] = loss.argmin(axis=1)
                along[:, m] = np.take_along_axis(inner, codes[:, m, None], axis=1)[:, 0]
                total = rest + along[:, m]
        return codes.astype(np.uint8)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """(queries, subspaces, 16): inner products of the query with each centroid."""
        return np.einsum("qmp,mcp->qmc", _parts(q, len(self.centers)), self.centers).astype(np.float32)


def _byte_table(tables: np.ndarray, b: int) -> np.ndarray:
    """(queries, 256): the sums of both entries that byte b of a code names."""
    return (tables[:, 2 * b, None, :] + tables[:, 2 * b + 1, :, None]).reshape(len(tables), 256)


def wave_blocks(dimensions: int, rerank: int, budget: int = WAVE_BYTES) -> int:
    """Query blocks of a wave: for each query its vector (8 bytes a component), tables (32 bytes a component), and `rerank` ids and scores (12 bytes).

    Two tables and the anchors' distances are held for each, so callers give twice the components and an eighth of the anchors more."""
    return max(1, min(OPEN_BLOCKS, budget // (QUERY_BLOCK * (40 * dimensions + 12 * rerank))))


def _parts(x: np.ndarray, subspaces: int) -> np.ndarray:
    out = np.zeros((len(x), subspaces * PART), x.dtype)
    out[:, : x.shape[1]] = x
    return out.reshape(len(x), subspaces, PART)


def fit_codebooks(x: np.ndarray, threshold: float = THRESHOLD, rounds: int = 6) -> Codebooks:
    """Codebooks for the rows of x: alternate between codes and the least-squares centroids of the anisotropic loss."""
    d = x.shape[1]
    subspaces = -(-d // (2 * PART)) * 2
    weight = max(1.0, (d - 1) * threshold**2 / (1 - threshold**2)) - 1
    parts, norm = _parts(x, subspaces), np.maximum((x**2).sum(axis=1), 1e-30)
    start = np.linspace(0, len(x) - 1, CENTROIDS).astype(int)
    order = np.argsort(parts[:, :, 0], axis=0)
    centers = np.stack([parts[order[start, m], m] for m in range(subspaces)])
    for _ in range(8):  # plain k-means first
        for m in range(subspaces):
            code = ((parts[:, m, None, :] - centers[m]) ** 2).sum(axis=2).argmin(axis=1)
            for c in np.unique(code):
                centers[m, c] = parts[code == c, m].mean(axis=0)
    for _ in range(rounds):
        codes = Codebooks(centers, weight).encode(x, 1)
        along = np.stack([((parts[:, m] - centers[m][codes[:, m]]) * parts[:, m]).sum(axis=1) for m in range(subspaces)], axis=1)
        for m in range(subspaces):
            rest = along.sum(axis=1) - along[:, m]
            for c in np.unique(codes[:, m]):
                mine = codes[:, m] == c
                p, n = parts[mine, m], norm[mine]
                left = len(p) * np.eye(PART) + weight * (p / n[:, None]).T @ p
                right = p.sum(axis=0) + weight * ((rest[mine] + (p**2).sum(axis=1)) / n) @ p
                centers[m, c] = np.linalg.solve(left, right)
            along[:, m] = ((parts[:, m] - centers[m][codes[:, m]]) * parts[:, m]).sum(axis=1)
    return Codebooks(centers, weight)


class Anchored(NamedTuple):
    """Anchors, and codebooks for directions from them and for what these leave. Places are (x - origin) / unit."""

    origin: np.ndarray
    unit: float
    anchors: np.ndarray
    first: Codebooks
    second: Codebooks

    def place(self, x: np.ndarray) -> np.ndarray:
        return (x - self.origin) / self.unit

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (rows, subspaces of both codebooks), and of each row its anchor, s, the length of what the first code leaves, and all that no query changes."""
        y = self.place(x)
        anchor = _nearest_anchor(y, self.anchors)
        c = self.anchors[anchor]
        s, u = _direction(y - c)
        a = self.first.encode(u)
        t, v = _direction(u - _decoded(self.first, a, u.shape[1]))
        b = self.second.encode(v)
        coded = _decoded(self.first, a, u.shape[1]) + t[:, None] * _decoded(self.second, b, u.shape[1])
        return np.hstack([a, b]), np.stack([anchor, s, t, -s * (c * coded).sum(axis=1) - s**2 / 2])

    def query(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tables of both codebooks, and -|q - c|^2 / 2 for each anchor."""
        y = self.place(q)
        far = np.stack([((y - c) ** 2).sum(axis=1) for c in self.anchors], axis=1)
        return self.first.tables(y), self.second.tables(y), np.maximum(-far / 2, -1e37).astype(np.float32)


def _nearest_anchor(y: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    return ((anchors**2).sum(axis=1) - 2 * (y @ anchors.T)).argmin(axis=1)


def _direction(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and rows of length 1; zero stays zero."""
    size = np.sqrt((x**2).sum(axis=1))
    return size, x / np.where(size > 0, size, 1)[:, None]


def _decoded(books: Codebooks, codes: np.ndarray, d: int) -> np.ndarray:
    return np.concatenate([c[codes[:, m]] for m, c in enumerate(books.centers)], axis=1)[:, :d]


def fit_anchored(x: np.ndarray) -> Anchored:
    origin = np.median(x, axis=0)
    size = np.sqrt(((x - origin) ** 2).sum(axis=1))
    unit = float(np.median(size[size > 0])) if (size > 0).any() else 1.0
    y = (x - origin) / unit
    # rows that are far from the anchors before come first, so that no group is without one
    rng, anchors, gap = np.random.default_rng(0), [y[0]], ((y - y[0]) ** 2).sum(axis=1)
    while len(anchors) < min(ANCHORS, len(y)) and (gap > 0).any():
        weight = np.sqrt(gap)
        anchors.append(y[rng.choice(len(y), p=weight / weight.sum())])
        gap = np.minimum(gap, ((y - anchors[-1]) ** 2).sum(axis=1))
    anchors = np.array(anchors)
    for _ in range(ANCHOR_ROUNDS):
        mine = _nearest_anchor(y, anchors)
        for c in np.unique(mine):
            anchors[c] = y[mine == c].mean(axis=0)
    _, u = _direction(y - anchors[_nearest_anchor(y, anchors)])
    first = fit_codebooks(u)
    _, v = _direction(u - _decoded(first, first.encode(u), x.shape[1]))
    return Anchored(origin, unit, anchors, first, fit_codebooks(v, threshold=0.0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _index(batches: Iterator[pa.RecordBatch], books) -> Iterator[pa.RecordBatch]:
    """Blocks of the index: ids, codes (a byte for two subspaces), and anchor, lengths and constant of each vector."""
    for batch in batches:
        for a in range(0, batch.num_rows, INDEX_BLOCK):
            part = batch.slice(a, INDEX_BLOCK)
            x = _matrix(part.column(1))
            codes, numbers = books.value.encode(x)
            packed = codes[:, 0::2] | codes[:, 1::2] << 4
            ids = part.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            yield pa.RecordBatch.from_pydict({"ids": [ids.tobytes()], "codes": [np.ascontiguousarray(packed.T).tobytes()], "numbers": [numbers.astype("<f8").tobytes()]}, schema=pa.schema([("ids", pa.binary()), ("codes", pa.binary()), ("numbers", pa.binary())]))


def _scan(batches: Iterator[pa.RecordBatch], books, wave, rerank: int) -> Iterator[pa.RecordBatch]:
    """For each query of the wave the best `rerank` vectors of this task's part of the index, by the sum of table entries."""
    best = [[q_ids, books.value.query(q), np.full((len(q_ids), rerank), -np.inf, np.float32), np.zeros((len(q_ids), rerank), np.int64)] for q_ids, q in wave.value]
    for batch in batches:
        for row in batch.to_pylist():
            new_ids = np.frombuffer(row["ids"], "<i8")
            codes = np.frombuffer(row["codes"], np.uint8).reshape(-1, len(new_ids))
            anchor, s, t, rest = np.frombuffer(row["numbers"], "<f8").reshape(4, -1)
            anchor, s, t, rest = anchor.astype(np.int64), np.minimum(s, 1e18).astype(np.float32), t.astype(np.float32), np.maximum(rest, -1e37).astype(np.float32)
            for block in best:
                q_ids, tables, scores, ids = block
                first, second, far = tables
                half = len(codes) // 2
                near = np.zeros((len(q_ids), len(new_ids)), np.float32)
                for b in range(half):
                    near += _byte_table(second, b)[:, codes[half + b]]
                near *= t
                for b in range(half):
                    near += _byte_table(first, b)[:, codes[b]]
                near *= s
                near += rest
                near += far[:, anchor]
                all_scores = np.hstack([scores, near])
                top = np.argpartition(-all_scores, min(rerank, all_scores.shape[1] - 1), axis=1)[:, :rerank]
                all_ids = np.hstack([ids, np.broadcast_to(new_ids, near.shape)])
                block[2:] = [np.take_along_axis(all_scores, top, axis=1), np.take_along_axis(all_ids, top, axis=1)]
    for q_ids, _, scores, ids in best:
        ok = np.isfinite(scores)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q_ids, ok.sum(axis=1))), pa.array(ids[ok]), pa.array(scores[ok].astype(np.float64))], names=["query_key", "vid", "near"])


def _wave(queries: DataFrame, blocks: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(keys, vectors) of the queries of each block: OPEN_BLOCKS * QUERY_BLOCK vectors or so."""
    rows = queries.where(F.col("block").isin(blocks)).select("block", "query_key", "embedding").collect()
    return [(np.array([r[1] for r in rows if r[0] == b], np.int64), np.array([r[2] for r in rows if r[0] == b], np.float64)) for b in blocks if any(r[0] == b for r in rows)]


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, rerank: int | None = None, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other vectors of each vector whose vec_id is divisible by `every`.

    score is the Euclidean distance in double precision; ties go to the smaller vec_id. Rows with a null id, and vectors that are
    null, empty, all zero, of another length than most, or that hold a null or non-finite component, take no part. Repeated
    rows count once. An empty table gives an empty result. Other columns are ignored.
    """
    spark = vectors.sparkSession
    small_batches(spark, INDEX_BLOCK)
    rows = pick(vectors, vec_id="long", embedding="array<double>").where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    fine = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = rows.where(fine)
    length = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if length is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("embedding") == length["d"]).dropDuplicates(["vec_id", "embedding"])
    turn = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = rows.withColumn("turn", turn).where(F.col("turn") <= k + 1)
    classes = few.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("members")).withColumn("vid", F.col("members")[0])
    # ids may repeat with other vectors, so classes get keys of their own
    classes = stored(classes.withColumn("vid", F.xxhash64("vid", "embedding")), "vector-classes")
    queries = stored(rows.where(F.col("vec_id") % every == 0).select(F.xxhash64("vec_id", "embedding").alias("query_key"), F.col("vec_id").alias("query_id"), "embedding"), "vector-queries")
    chosen = np.array([r[0] for r in classes.select("embedding", F.xxhash64("vid").alias("p")).orderBy("p").limit(sample).collect()], np.float64)
    books = spark.sparkContext.broadcast(fit_anchored(chosen))
    rerank = rerank or int(RERANK * max(1.0, classes.count() / RERANK_ROWS) ** 0.25)
    index = stored(classes.select("vid", "embedding").mapInArrow(partial(_index, books=books), "ids binary, codes binary, numbers binary"), "vector-index")
    parts = index.count()
    parts = max(1, min(parts, max(spark.sparkContext.defaultParallelism, -(-parts // PART_BLOCKS))))
    index = stored(index.repartition(parts), "vector-index-parts")

    # every query meets every index block (a stated query set against all rows): waves of queries go to the index, which stays where it is
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    dealt = queries.withColumn("block", F.pmod("query_key", F.lit(blocks)).cast("int"))
    place = F.row_number().over(Window.partitionBy("query_key").orderBy(F.desc("near"), "vid"))
    found = []
    many = wave_blocks(2 * length["d"] + ANCHORS // 8, rerank)
    for a in range(0, blocks, many):
        wave = spark.sparkContext.broadcast(_wave(dealt, list(range(a, min(blocks, a + many)))))
        scanned = index.mapInArrow(partial(_scan, books=books, wave=wave, rerank=rerank), "query_key long, vid long, near double")
        found.append(stored(scanned.withColumn("place", place).where(F.col("place") <= rerank).select("query_key", "vid"), "vector-candidates"))
    candidates = reduce(DataFrame.unionByName, found)
    exact = candidates.join(classes, "vid").join(queries.withColumnRenamed("embedding", "q"), "query_key")
    distance = F.sqrt(F.aggregate(F.zip_with("q", "embedding", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    found = exact.select("query_id", "query_key", distance.alias("score"), F.explode("members").alias("vec_id")).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_key").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
