"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (seeded by its code point). A trigram is bound as the product of its letters'
vectors, shifted by two, one and no places. A text is the bundle (sum) of its trigrams, a language the bundle of
its texts scaled to length one. A text gets the language whose prototype is nearest by cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociq.llm.common import crc32_bucket, pick, released, small_batches

DIMENSIONS = 1024
#: Trigrams whose vectors a worker keeps (a byte for each dimension); then it starts anew.
KEPT = 50_000
#: Letters of the texts that are bundled at a time.
PIECE = 1 << 20
#: Unit vectors are summed as whole numbers of this size, so that sums do not depend on their order.
SCALE = 1 << 20
UNKNOWN = "und"
#: A text is accepted from half the cosine that this share of its language's learning texts stays below, and from four
#: standard deviations of the cosine of unrelated vectors at least.
LOW, MARGIN, DEVIATIONS = 0.01, 0.5, 4
#: Steps of the cosine in which learning texts are counted.
STEPS = 1000


@cache
def _alphabet() -> np.ndarray:
    """Whether each code point is a letter; made once for a worker."""
    out = np.zeros(0x110000, bool)
    out[[c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]] = True
    return out


class Profiles:
    """Bundled trigram vectors of texts."""

    def __init__(self, dimensions: int = DIMENSIONS) -> None:
        self.d = dimensions
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.vectors = np.empty((4096, dimensions), np.int8)
        self.alpha = _alphabet()

    def letter(self, code: int) -> np.ndarray:
        v = self.letters.get(code)
        if v is None:
            bits = np.random.default_rng(0x1D + code).integers(0, 2, self.d, dtype=np.int8)
            v = self.letters[code] = bits * np.int8(2) - np.int8(1)
        return v

    def _rows(self, grams: np.ndarray) -> np.ndarray:
        if len(self.rows) + len(grams) > KEPT:
            self.rows.clear()
        new = [g for g in grams.tolist() if g not in self.rows]
        base = len(self.rows)
        if base + len(new) > len(self.vectors):
            grown = np.empty((2 * (base + len(new)), self.d), np.int8)
            grown[:base] = self.vectors[:base]
            self.vectors = grown
        for k in range(0, len(new), 4096):
            part = new[k : k + 4096]
            a, b, c = (np.stack([np.roll(self.letter(g >> shift & 0x1FFFFF), turn) for g in part]) for shift, turn in ((42, 2), (21, 1), (0, 0)))
            self.vectors[base + k : base + k + len(part)] = a * b * c
        self.rows.update((g, base + k) for k, g in enumerate(new))
        return np.array([self.rows[g] for g in grams.tolist()], np.int64)

    def bundle(self, texts: list[str | None], piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
        """(vectors of length one, has_letter); a text with letters always has a trigram, as spaces stand round it. Texts of about
        `piece` letters are worked on at a time, or one text that is longer."""
        vectors, lettered = np.zeros((len(texts), self.d), np.float32), np.zeros(len(texts), bool)
        a = 0
        while a < len(texts):
            z, size = a + 1, len(texts[a] or "")
            while z < len(texts) and size + len(texts[z] or "") <= piece:
                size += len(texts[z] or "")
                z += 1
            vectors[a:z], lettered[a:z] = self._bundled(texts[a:z])
            a = z
        return vectors, lettered

    def _bundled(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        joined = "\0".join(f" {(t or '').replace(chr(0), ' ')} " for t in texts).lower()
        codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
        m = np.where(self.alpha[codes], codes, np.where(codes == 0, 0, 32)).astype(np.int64)
        keep = np.ones(len(m), bool)
        keep[1:] = (m[1:] != 32) | (m[:-1] != 32)
        m = m[keep]
        text = np.cumsum(m == 0)
        n = len(texts)
        lettered = np.zeros(n, bool)
        lettered[np.unique(text[m > 32])] = True
        out = np.zeros((n, self.d), np.float32)
        if len(m) > 2:
            ok = (m[:-2] > 0) & (m[1:-1] > 0) & (m[2:] > 0)
            grams, inverse = np.unique((m[:-2] << 42 | m[1:-1] << 21 | m[2:])[ok], return_inverse=True)
            key, counts = np.unique(text[:-2][ok] * max(len(grams), 1) + inverse, return_counts=True)
            owner, gram = key // max(len(grams), 1), key % max(len(grams), 1)
            edge = np.searchsorted(owner, np.arange(n + 1))
            for start in range(0, len(grams), KEPT // 2):  # a batch may hold more distinct trigrams than are kept
                rows = self._rows(grams[start : start + KEPT // 2])
                for k in np.flatnonzero(np.diff(edge)).tolist():
                    mine = slice(edge[k], edge[k + 1])
                    g, c = gram[mine] - start, counts[mine]
                    if len(grams) > KEPT // 2:
                        inside = (g >= 0) & (g < len(rows))
                        g, c = g[inside], c[inside]
                    out[k] += c.astype(np.float32) @ self.vectors[rows[g]].astype(np.float32)
        out[~lettered] = 0
        size = np.sqrt((out.astype(np.float64) ** 2).sum(axis=1))
        return (out / np.maximum(size, 1e-30)[:, None]).astype(np.float32), lettered & (size > 0)


@released
def _sums(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[pa.RecordBatch]:
    profiles, total = Profiles(dimensions), {}
    for batch in batches:
        vectors, lettered = profiles.bundle(batch.column(0).to_pylist())
        whole = np.rint(vectors.astype(np.float64) * SCALE).astype(np.int64)
        langs = np.array(batch.column(1).to_pylist(), object)
        for lang in set(langs[lettered]):
            total[lang] = total.get(lang, 0) + whole[lettered & (langs == lang)].sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))], names=["lang", "v"])


def learn_prototypes(labelled: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """(languages, vectors of length one) from all rows of labelled (text, lang), summed on the executors."""
    parts = labelled.mapInArrow(partial(_sums, dimensions=dimensions), "lang string, v array<long>")
    sums = parts.select("lang", F.posexplode("v")).groupBy("lang", "pos").agg(F.sum("col").alias("v"))
    rows = sums.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda x: x.v).alias("v")).orderBy("lang").collect()
    langs = [r[0] for r in rows]
    v = np.array([r[1] for r in rows], np.float64).reshape(len(rows), dimensions)
    return langs, v / np.maximum(np.sqrt((v**2).sum(axis=1, keepdims=True)), 1e-30)


def predict(profiles: Profiles, texts: list[str | None], langs: list[str], prototypes: np.ndarray) -> tuple[list[str], np.ndarray]:
    vectors, lettered = profiles.bundle(texts)
    if not langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    cosine = vectors.astype(np.float64) @ prototypes.T
    best = cosine.argmax(axis=1)
    score = np.where(lettered, np.clip(cosine[np.arange(len(texts)), best], 0.0, 1.0), 0.0)
    return [langs[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist(), strict=True)], score


@released
def _scored(batches: Iterator[pa.RecordBatch], dimensions: int, model) -> Iterator[pa.RecordBatch]:
    profiles, (langs, prototypes) = Profiles(dimensions), model.value
    for batch in batches:
        found, score = predict(profiles, batch.column(2).to_pylist(), langs, prototypes)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])


@released
def _kept(batches: Iterator[pa.RecordBatch], dimensions: int, model, least: dict[str, float], at: int | None) -> Iterator[pa.RecordBatch]:
    profiles, (langs, prototypes) = Profiles(dimensions), model.value
    for batch in batches:
        found, score = predict(profiles, [None] * batch.num_rows if at is None else batch.column(at).to_pylist(), langs, prototypes)
        yield batch.filter(pa.array([f != UNKNOWN and x >= least[f] for f, x in zip(found, score.tolist(), strict=True)], pa.bool_()))


@released
def _own_cosines(batches: Iterator[pa.RecordBatch], dimensions: int, model) -> Iterator[pa.RecordBatch]:
    profiles, (langs, prototypes) = Profiles(dimensions), model.value
    place, counts = {g: k for k, g in enumerate(langs)}, np.zeros((len(langs), STEPS + 1), np.int64)
    for batch in batches:
        vectors, lettered = profiles.bundle(batch.column(0).to_pylist())
        own = np.array([place.get(g, -1) for g in batch.column(1).to_pylist()], np.int64)
        ok = lettered & (own >= 0)
        cosine = (vectors[ok].astype(np.float64) * prototypes[own[ok]]).sum(axis=1)
        np.add.at(counts, (own[ok], (np.clip(cosine, 0, 1) * STEPS).astype(int)), 1)
    k, step = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array([langs[i] for i in k], pa.string()), pa.array(step, pa.int32()), pa.array(counts[k, step], pa.int64())], names=["lang", "step", "n"])


def least_cosines(labelled: DataFrame, model, dimensions: int = DIMENSIONS) -> dict[str, float]:
    """The cosine from which a text is accepted for each learned language, from those of all its learning texts (text, lang)."""
    counts = labelled.mapInArrow(partial(_own_cosines, dimensions=dimensions, model=model), "lang string, step int, n long").groupBy("lang", "step").agg(F.sum("n").alias("n"))
    steps: dict[str, list[tuple[int, int]]] = {}
    for lang, step, n in counts.collect():  # STEPS rows for each language at most
        steps.setdefault(lang, []).append((step, n))
    floor = DEVIATIONS / dimensions**0.5
    least = dict.fromkeys(model.value[0], floor)
    for lang, found in steps.items():
        found.sort()
        total = np.cumsum([n for _, n in found])
        low = found[int(np.searchsorted(total, LOW * total[-1], side="right"))][0] / STEPS
        least[lang] = max(floor, MARGIN * low)
    return least


def _learn(docs: DataFrame, folds: int, fold: int, dimensions: int):
    small_batches(docs.sparkSession)
    rows = pick(docs, doc_id="long", text="string", lang="string").withColumn("held_out", F.coalesce(crc32_bucket(F.col("doc_id"), folds) == fold, F.lit(False)))
    known = rows.where("NOT held_out AND lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    model = learn_prototypes(known, dimensions)
    return rows, known, docs.sparkSession.sparkContext.broadcast(model)


def identify_languages(docs: DataFrame, folds: int = 4, fold: int = 2, dimensions: int = DIMENSIONS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs.

    Prototypes come from the text and the lang of all rows that are not held out and have both. A text that is null or has no
    letter is `und` with score 0; so is every text if there is nothing to learn from. A null doc_id counts as not
    held out. Repeated rows are scored each; an empty table gives an empty result; other columns are ignored. Ties go to the
    language that sorts first.
    """
    rows, _, model = _learn(docs, folds, fold, dimensions)
    return rows.select("doc_id", "held_out", "text").mapInArrow(partial(_scored, dimensions=dimensions, model=model), "doc_id long, held_out boolean, lang_pred string, score double")


def known_language_only(docs: DataFrame, least: float | None = None, folds: int = 4, fold: int = 2, dimensions: int = DIMENSIONS) -> DataFrame:
    """The rows of docs, with all their columns, whose text has letters and is near enough to its nearest language: by `least`, or
    without it by what the language's own learning texts show (least_cosines)."""
    _, known, model = _learn(docs, folds, fold, dimensions)
    limits = least_cosines(known, model, dimensions) if least is None else dict.fromkeys(model.value[0], least)
    at = next((k for k, c in enumerate(docs.columns) if c.lower() == "text"), None)  # without the column there is no text to keep
    return docs.mapInArrow(partial(_kept, dimensions=dimensions, model=model, least=limits, at=at), docs.schema)
