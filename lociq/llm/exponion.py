"""Centroid clustering of whole-number vectors by Exponion search.

Each vector keeps an upper bound of the distance to its centroid and a lower bound of that to every other one. A round moves the
bounds by what the centroids moved. A vector whose upper bound stays below the lower one, or below half the way from its
centroid to the nearest other one, keeps its centroid unseen. Any other looks only at centroids in a ball around its own,
taken from that centroid's sorted list of distances. All distances that decide are exact whole numbers; bounds are
floating-point numbers rounded outwards, and the ball includes its rim, so ties are seen and go to the smaller number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociq.llm.common import pick
from lociq.storage import Rounds

#: The lists of distances between centroids take 12 bytes a pair in each worker, so there may be no more centroids.
MAX_CENTROIDS = 2048
#: Components are whole numbers below this; squared distances of up to 64 components then fit 63 bits.
LIMIT = 1 << 27
#: Bounds are widened by this share; the error of a square root and a few sums is smaller.
ROUNDING = 1e-12
STATE = "vec_id long, v array<int>, was int, cluster int, upper double, lower double"
FINAL = "vec_id long, cluster int, distance long"
#: Rows whose distances are computed at a time.
BLOCK = 4096


def _out(x):
    return x * (1 + ROUNDING)


def _in(x):
    return x * (1 - ROUNDING)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number rows of x to rows of c."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * most * most * x.shape[1] < 1 << 53:  # every product and sum is a whole number that a double holds
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)


class Centroids:
    """Centroids with the sorted lists of distances from each to all, and what each moved in the last round."""

    def __init__(self, c: np.ndarray, before: np.ndarray | None = None) -> None:
        self.c = c
        between = np.sqrt(squared(c, c).astype(np.float64))
        self.order = np.argsort(between, axis=1, kind="stable").astype(np.int32)
        self.near = np.take_along_axis(between, self.order, axis=1)
        self.gap = self.near[:, 1] if len(c) > 1 else np.full(1, np.inf)
        self.moved = np.zeros(len(c)) if before is None else _out(np.sqrt(((c - before) ** 2).sum(axis=1).astype(np.float64)))
        far = np.argsort(self.moved)[::-1]
        self.others = np.full(len(c), self.moved[far[0]])  # the farthest move of any other centroid
        self.others[far[0]] = self.moved[far[1]] if len(c) > 1 else 0.0

    def own(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return ((x - self.c[at]) ** 2).sum(axis=1)


def assign(x: np.ndarray, at: np.ndarray, upper: np.ndarray, lower: np.ndarray, table: Centroids) -> int:
    """Move each row of x (int64) to its nearest centroid, in place in at, upper and lower; the number of distances computed."""
    upper[:] = _out(upper + table.moved[at])
    lower[:] = np.maximum(_in(lower - table.others[at]), 0.0)
    safe = np.maximum(lower, _in(table.gap[at] / 2))
    open_ = np.flatnonzero(~(upper < safe))
    upper[open_] = _out(np.sqrt(table.own(x[open_], at[open_]).astype(np.float64)))
    seen = len(open_)
    open_ = open_[~(upper[open_] < safe[open_])]
    open_ = open_[np.argsort(at[open_], kind="stable")]
    for rows in np.split(open_, np.flatnonzero(np.diff(at[open_])) + 1) if len(open_) else []:
        a = int(at[rows[0]])
        inside = np.searchsorted(table.near[a], _out(2 * upper[rows] + table.gap[a]), side="right")
        band = np.ceil(np.log2(inside)).astype(int)  # rows whose ball holds up to 2, 4, 8, ... centroids look at so many together
        for b in np.unique(band).tolist():
            ids = np.sort(table.order[a, : 1 << b])
            some = rows[band == b]
            for part in np.split(some, range(BLOCK, len(some), BLOCK)):
                d = squared(x[part], table.c[ids])
                seen += d.size
                first, line = d.argmin(axis=1), np.arange(len(part))  # of equal ones the smallest number
                at[part], best = ids[first], d[line, first]
                d[line, first] = np.iinfo(np.int64).max
                upper[part] = _out(np.sqrt(best.astype(np.float64)))
                lower[part] = _in(np.sqrt(d.min(axis=1).astype(np.float64))) if d.shape[1] > 1 else np.inf
    return seen


def _round(batches: Iterator[pa.RecordBatch], table, dim: int, last: bool) -> Iterator[pa.RecordBatch]:
    table = table.value
    for batch in batches:
        x = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)
        at, upper, lower = (batch.column(n).to_numpy(zero_copy_only=False).copy() for n in ("cluster", "upper", "lower"))
        was = at.copy()
        was[np.isinf(upper)] = -1  # not yet assigned
        assign(x, at, upper, lower, table)
        if last:
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(at, pa.int32()), pa.array(table.own(x, at), pa.int64())], names=["vec_id", "cluster", "distance"])
        else:
            new = [pa.array(was, pa.int32()), pa.array(at, pa.int32()), pa.array(upper), pa.array(lower)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), *new], names=["vec_id", "v", "was", "cluster", "upper", "lower"])


def whole_vectors(vectors: DataFrame, dim: int = 64, scale: int = 64) -> DataFrame:
    """vec_id, v: floor(scale * x) of the vectors with exactly dim components, all finite and small enough (see clusters)."""
    x = F.col("embedding")
    fits = lambda e: F.coalesce(F.abs(e) < LIMIT / scale, F.lit(False))  # noqa: E731  NaN is greater than any number
    kept = pick(vectors, vec_id="long", embedding="array<double>").where((F.size(x) == dim) & F.forall(x, fits))
    return kept.select("vec_id", F.transform(x, lambda e: F.floor(scale * e).cast("int")).alias("v"))


def _moved_sums(state: DataFrame, dim: int) -> list:
    """For each centroid what the vectors that came and went change in its count and sums."""
    both = F.array(F.struct(F.col("cluster").alias("c"), F.lit(1).alias("sign")), F.struct(F.col("was").alias("c"), F.lit(-1).alias("sign")))
    rows = state.where("cluster <> was").select("v", F.explode(both).alias("m")).where("m.c >= 0").select("v", "m.*")
    sums = [F.sum(F.col("v")[i].cast("long") * F.col("sign")) for i in range(dim)]
    return rows.groupBy("c").agg(F.sum("sign"), *sums).collect()  # a row for each centroid


def seeds(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of `seed:vec_id`, in that order; vectors of one id by their components."""
    order: list[Column] = [F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256), F.col("v")]
    return np.array([r[0] for r in kept.where("vec_id IS NOT NULL").orderBy(*order).limit(k).select("v").collect()], np.int64)


def clusters(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, dim: int = 64, scale: int = 64) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each vector that takes part.

    A vector takes part if it has exactly `dim` components, none of them null, NaN or infinite, and scaled components stay
    below 2**27 (beyond, squared distances leave 63 bits). A null vec_id takes part but is no seed. With fewer vectors than k
    each is a centroid. Repeated rows are vectors of their own. Empty centroids stay where they are. Without vectors the result is
    empty. Other columns are ignored. An inertia above 63 bits is null.

    A round is one pass that writes vectors and bounds to the shared folder; the table of the round before is then deleted. Sums follow
    from the vectors that changed their centroid alone. The driver holds k centroids (2,048 at most) and their sums.
    """
    if not 0 < k <= MAX_CENTROIDS:
        raise ValueError(f"k must be from 1 to {MAX_CENTROIDS}")
    if dim > 64:
        raise ValueError("at most 64 components, so that squared distances fit 63 bits")
    spark, tables = vectors.sparkSession, Rounds(vectors.sparkSession)
    kept = whole_vectors(vectors, dim, scale)
    c = seeds(kept, k, seed)
    if not len(c):
        return spark.createDataFrame([], f"{FINAL}, cluster_inertia long, inertia long, centroid_sha256 string")
    count, total = [0] * len(c), [[0] * dim for _ in c]
    state = kept.select("*", F.lit(-1).alias("was"), F.lit(0).alias("cluster"), F.lit(float("inf")).alias("upper"), F.lit(0.0).alias("lower"))
    table = Centroids(c)
    for _ in range(rounds):
        state = tables.next(state.mapInArrow(partial(_round, table=spark.sparkContext.broadcast(table), dim=dim, last=False), STATE), "exponion")
        for j, n, *changes in _moved_sums(state, dim):
            count[j] += n
            total[j] = [a + b for a, b in zip(total[j], changes, strict=True)]
        c = np.array([[a // count[j] for a in total[j]] if count[j] else table.c[j].tolist() for j in range(len(c))], np.int64)
        table = Centroids(c, table.c)
    found = tables.next(state.mapInArrow(partial(_round, table=spark.sparkContext.broadcast(table), dim=dim, last=True), FINAL), "exponion-final")
    tables.drop("exponion")
    return found.join(F.broadcast(_summary(spark, found, c)), "cluster")


def _summary(spark: SparkSession, found: DataFrame, c: np.ndarray) -> DataFrame:
    """A row for each non-empty cluster: its inertia, that of all, and the hash of its centroid."""
    sums = dict(found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    fits = lambda n: int(n) if n < 1 << 63 else None
    rows = [(j, fits(s), fits(sum(sums.values())), hashlib.sha256(",".join(map(str, c[j].tolist())).encode()).hexdigest()) for j, s in sums.items()]
    return spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")


def _sql_round(k: int) -> str:
    return f"""
a{k} AS (SELECT vec_id, min_by(c, (d, c)) AS c, min(d) AS d FROM (SELECT x.vec_id, z.c, sum((x.v - z.v) * (x.v - z.v))::BIGINT AS d FROM x JOIN c{k} z USING (i) GROUP BY ALL) GROUP BY vec_id)"""


def _sql_move(k: int) -> str:
    return f"""
m{k} AS (SELECT a.c, x.i, sum(x.v)::BIGINT AS s, count(*) AS n FROM x JOIN a{k} a USING (vec_id) GROUP BY ALL),
c{k + 1} AS (SELECT z.c, z.i, CASE WHEN m.n IS NULL THEN z.v ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS v FROM c{k} z LEFT JOIN m{k} m USING (c, i))"""


#: All distances in SQL. It takes vec_id as unique and not null.
ORACLE = f"""
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda u: u IS NULL OR NOT isfinite(u))) = 0),
x AS (SELECT vec_id, unnest(range(64)) AS i, unnest(list_transform(e, lambda u: floor(64 * u)::BIGINT)) AS v FROM e),
first AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c FROM e QUALIFY c < 16),
c0 AS (SELECT c, i, v FROM first JOIN x USING (vec_id)),{','.join(_sql_round(k) + ',' + _sql_move(k) for k in range(3))},{_sql_round(3)},
h AS (SELECT c, sha256(string_agg(v::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c3 GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a3 JOIN h USING (c)
"""
