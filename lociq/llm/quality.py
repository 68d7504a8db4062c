"""Quality classifier by co-training.

Two logistic classifiers see different views of a document: one its text (shares of character kinds, word and line statistics), one
its metadata (source, language, stated length). Each round, either one labels unlabelled documents of which it is sure, for the
other to learn from; its sureness is a calibrated probability. At last both are calibrated on the labelled documents, and
their log odds are added.

The models are fitted on a bounded sample of the labelled documents (`labelled` rows, those with the smallest hash of doc_id) and on the
pseudo-labels. These come from all documents: in each round every one is scored, and the surest `per_round` of each label and view, among
documents with different features, are found by a distributed top-k. Every document is scored at last.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociq.llm.common import pick, picked, released, small_batches
from lociq.llm.words import distinct_ranges, slices, text_buffers, word_bounds

#: Bound of the labelled sample that the models are fitted on.
LABELLED = 4000
#: Rounds of exchange, the least probability of a pseudo-label, and pseudo-labels of each kind in the first round (each later one adds as many).
ROUNDS, SURE, PER_ROUND = 2, 0.97, 200
_META = 64
_META_SIZE = 2 * _META + 10
_KINDS = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\r\n", b".,;:", b"!?", b"#$%&*@", b"|", b"<>{}[]()/\\", b"_=+~^`-", b"'\"", bytes(range(128, 256)), bytes(set(range(32)) - set(b"\t\r\n")) + b"\x7f")
_KIND_OF = np.zeros((256, len(_KINDS)), np.float64)
for _k, _bytes in enumerate(_KINDS):
    _KIND_OF[list(_bytes), _k] = 1.0


def text_features(column: pa.Array) -> np.ndarray:
    """A row of statistics for each text; a null text is empty."""
    data, off, _ = text_buffers(column)
    n = len(off) - 1
    hist = np.zeros((n, 256))
    words, distinct, lines, distinct_lines = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for r, (a, z) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
        if z > a:
            hist[r] = np.bincount(data[a:z], minlength=256)
            split = [x for x in data[a:z].tobytes().split(b"\n") if x.strip()]
            lines[r], distinct_lines[r] = len(split), len(set(split))
    for s in slices(data, off):
        starts, ends, first = word_bounds(s)
        _, inverse = distinct_ranges(s.data, starts, ends)
        words[s.rows] += np.diff(first)
        for r, a, z in zip(s.rows.tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
            distinct[r] += len(np.unique(inverse[a:z]))
    size = np.maximum(hist.sum(axis=1), 1)
    shares = hist @ _KIND_OF / size[:, None]
    length = np.log1p(hist.sum(axis=1))
    more = [length, np.log1p(words), size / np.maximum(words, 1) / 10, distinct / np.maximum(words, 1), distinct_lines / np.maximum(lines, 1), lines / np.maximum(words, 1)]
    return np.column_stack([shares, np.sqrt(shares), *more])


def meta_features(source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """A row for each document's metadata: hashed source and language, length in steps."""
    out = np.zeros((len(source), _META_SIZE))
    for r, (s, g, n) in enumerate(zip(source.to_pylist(), lang.to_pylist(), n_chars.to_pylist(), strict=True)):
        out[r, zlib.crc32((s or "").encode()) % _META] = 1
        out[r, _META + zlib.crc32((g or "").encode()) % _META] = 1
        out[r, 2 * _META + min(9, int(math.log2(max(n or 0, 1)) / 2))] = 1
    return out


class Logistic(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def odds(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return z @ self.weights[:-1] + self.weights[-1]


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> Logistic:
    """Ridge logistic regression by Newton's method; deterministic."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.column_stack([np.clip((x - mean) / scale, -8, 8), np.ones(len(x))])
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(mean, scale, w)


class View(NamedTuple):
    model: Logistic
    slope: float
    shift: float

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Calibrated log odds."""
        return self.slope * self.model.odds(x) + self.shift


def calibrated(x: np.ndarray, y: np.ndarray, more_x: np.ndarray, more_y: np.ndarray, folds: int = 4) -> View:
    """A view fitted on labelled and pseudo-labelled rows; slope and shift from labelled rows that the fold's model has not seen."""
    odds = np.zeros(len(x))
    for k in range(folds):
        out = np.arange(len(x)) % folds == k
        if len(set(y[~out])) < 2:
            return View(fit(np.vstack([x, more_x]), np.concatenate([y, more_y])), 1.0, 0.0)
        odds[out] = fit(np.vstack([x[~out], more_x]), np.concatenate([y[~out], more_y])).odds(x[out])
    scale = fit(odds[:, None], y, ridge=0.01)
    slope = float(scale.weights[0] / scale.scale[0])
    if slope <= 0:  # the view tells nothing: the prior only
        return View(fit(np.vstack([x, more_x]), np.concatenate([y, more_y])), 0.0, float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))))
    return View(fit(np.vstack([x, more_x]), np.concatenate([y, more_y])), slope, float(scale.weights[-1] - slope * scale.mean[0]))


class Model(NamedTuple):
    text: View
    meta: View
    prior: float

    def odds(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        t, m = self.text.odds(text), self.meta.odds(meta)
        return t, m, t + m - self.prior


def fitted(text: np.ndarray, meta: np.ndarray, y: np.ndarray, given: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Both views, each on the labelled rows and on the pseudo-labels that the other one gave it."""
    share = y.mean()
    return Model(calibrated(text, y, *given["text"]), calibrated(meta, y, *given["meta"]), float(np.log(share / (1 - share))))


def surest(odds: np.ndarray, x: np.ndarray, k: int, sure: float = SURE) -> np.ndarray:
    """Places of the surest k rows of each sign, of equal rows the first, whose probability is at least `sure`; strongest first."""
    limit = math.log(sure / (1 - sure))
    odds = np.round(odds, 6)  # the last bits depend on how rows are batched
    out = []
    for sign in (1, -1):
        able = np.flatnonzero(odds * sign >= limit)
        if len(able):
            able = able[np.unique(x[able], axis=0, return_index=True)[1]]  # ties stand by their features
            out.append(able[np.argsort(-odds[able] * sign, kind="stable")[:k]])
    return np.concatenate(out) if out else np.empty(0, np.int64)


@released
def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        t = text_features(batch.column("text"))
        m = meta_features(batch.column("source"), batch.column("lang"), batch.column("n_chars"))
        both = np.hstack([t, m]).astype(np.float32)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(list(both), pa.list_(pa.float32()))], names=["doc_id", "x"])


_COLUMNS = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}


def _sampled(rows: DataFrame, ids: list[int]) -> tuple[list[int], np.ndarray]:
    """Features of the documents with these ids (a bounded list); of rows that repeat a doc_id the smallest counts."""
    spark = rows.sparkSession
    few = F.broadcast(spark.createDataFrame([(i,) for i in ids], "doc_id long"))
    others = [c for c in _COLUMNS if c != "doc_id"]
    one = rows.join(few, "doc_id").groupBy("doc_id").agg(F.min(F.struct(*others)).alias("r")).select("doc_id", "r.*").orderBy("doc_id")
    found = {r[0]: r[1] for r in one.mapInArrow(_featured, "doc_id long, x array<float>").collect()}
    kept = [i for i in ids if i in found]
    return kept, np.array([found[i] for i in kept], np.float64).reshape(len(kept), -1)


@released
def _candidates(batches: Iterator[pa.RecordBatch], model, known, k: int) -> Iterator[pa.RecordBatch]:
    """This task's surest rows of each view and label."""
    best: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        fresh = np.array([i not in known.value for i in batch.column("doc_id").to_pylist()], bool)
        t = text_features(batch.column("text")).astype(np.float32)
        m = meta_features(batch.column("source"), batch.column("lang"), batch.column("n_chars")).astype(np.float32)
        both = np.hstack([t, m])[fresh]
        for view, odds in zip(("text", "meta"), model.value.odds(t.astype(np.float64), m.astype(np.float64))[:2], strict=True):
            x, o = np.vstack([best[view][0], both]) if view in best else both, np.concatenate([best[view][1], odds[fresh]]) if view in best else odds[fresh]
            top = surest(o, x, k)
            best[view] = (x[top], o[top])
    for view, (x, o) in best.items():
        yield pa.RecordBatch.from_arrays([pa.array([view] * len(o), pa.string()), pa.array(np.round(o, 6), pa.float64()), pa.array(list(x), pa.list_(pa.float32()))], names=["view", "odds", "x"])


def _pseudo_labels(rows: DataFrame, model: Model, ids: list[int], k: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For each view the features and labels of the surest rows of the table by the other view; at most 2 k rows each."""
    spark = rows.sparkSession
    found = rows.mapInArrow(partial(_candidates, model=spark.sparkContext.broadcast(model), known=spark.sparkContext.broadcast(frozenset(ids)), k=k), "view string, odds double, x array<float>")
    found = found.withColumn("label", F.col("odds") > 0).dropDuplicates(["view", "label", "x"])
    place = F.row_number().over(Window.partitionBy("view", "label").orderBy(F.desc(F.abs("odds")), "x"))  # 2 k rows of a task at most
    rows_of = found.withColumn("place", place).where(F.col("place") <= k).orderBy("view", "label", "place").collect()
    out = {}
    for teacher, pupil in (("text", "meta"), ("meta", "text")):
        mine = [r for r in rows_of if r["view"] == teacher]
        if not mine:
            out[pupil] = None
            continue
        x = np.array([r["x"] for r in mine], np.float64)
        cut = x.shape[1] - _META_SIZE
        part = x[:, :cut] if pupil == "text" else x[:, cut:]
        out[pupil] = (part, np.array([float(r["label"]) for r in mine]))
    return out


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS, per_round: int = PER_ROUND) -> Model | None:
    """The co-trained model; None if labels has not both kinds, or fewer than eight labelled documents."""
    rows = pick(docs, **_COLUMNS)
    marks = pick(labels, doc_id="long", quality="int").where("doc_id IS NOT NULL AND quality IS NOT NULL")
    ids = rows.select("doc_id").where("doc_id IS NOT NULL").distinct()
    known = marks.groupBy("doc_id").agg(F.max("quality").alias("quality")).join(ids, "doc_id", "left_semi")
    sample = {r[0]: r[1] for r in known.select("doc_id", "quality", F.xxhash64("doc_id").alias("p")).orderBy("p").limit(labelled).collect()}
    if len(sample) < 8 or len({v > 0 for v in sample.values()}) < 2:
        return None
    kept, x = _sampled(rows, list(sample))
    y = np.array([float(sample[i] > 0) for i in kept])
    cut = x.shape[1] - _META_SIZE
    none = {"text": (x[:0, :cut], y[:0]), "meta": (x[:0, cut:], y[:0])}
    model = fitted(x[:, :cut], x[:, cut:], y, none)
    for turn in range(rounds):
        given = _pseudo_labels(rows, model, kept, per_round * (turn + 1))
        model = fitted(x[:, :cut], x[:, cut:], y, {v: given[v] or none[v] for v in none})
    return model


def _odds(batch: pa.RecordBatch, model: Model | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if model is None:
        unknown = np.zeros(batch.num_rows)
        return unknown, unknown, unknown
    return model.odds(text_features(batch.column("text")), meta_features(batch.column("source"), batch.column("lang"), batch.column("n_chars")))


def _probability(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


@released
def _scores(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        t, m, both = (_probability(x) for x in _odds(batch, model.value))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(t), pa.array(m), pa.array(both)], names=["doc_id", "text_score", "meta_score", "score"])


@released
def _accepted(batches: Iterator[pa.RecordBatch], model, least: float, columns: int) -> Iterator[pa.RecordBatch]:
    """The accepted rows with their first columns; what the model reads comes behind them."""
    for batch in batches:
        own = pa.RecordBatch.from_arrays(batch.columns[:columns], schema=pa.schema(list(batch.schema)[:columns]))
        seen = pa.RecordBatch.from_arrays(batch.columns[columns:], names=list(_COLUMNS))
        yield own.filter(pa.array(_probability(_odds(seen, model.value)[2]) >= least))


def score_documents(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """doc_id, text_score, meta_score, score (calibrated probabilities of good quality), accepted for every row of docs.

    Nulls count as empty text, empty name or length 0. Without labels of both kinds nothing is known: every score is 0.5, and with
    the usual `least` every row is accepted. Repeated rows are scored each; an empty table gives an empty result; other columns are ignored. No shuffle of texts.
    """
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    scored = pick(docs, **_COLUMNS).mapInArrow(partial(_scores, model=model), "doc_id long, text_score double, meta_score double, score double")
    return scored.withColumn("accepted", F.col("score") >= least)


def good_documents(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The accepted rows of docs, with all their columns."""
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    own = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(*own, *picked(docs, "lociq_read_", **_COLUMNS))
    return rows.mapInArrow(partial(_accepted, model=model, least=least, columns=len(own)), docs.schema)
