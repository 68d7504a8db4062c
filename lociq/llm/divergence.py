"""Audit of how sources of a language differ in their words.

Words are counted within tasks and added up by Spark. Each kept term has a sparse vector of its counts by source; terms with the same
vector form one group, for which every pair of sources is evaluated once and multiplied by the number of its terms. All arithmetic
is on whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociq.llm.common import join_checked, pick, small_batches
from lociq.llm.words import Slice, distinct_ranges, slices, text_buffers
from lociq.storage import stored

#: A term is a run of ASCII letters and characters from U+0080 on; only A-Z are lower-cased.
PATTERN = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE, ADDED = 1_000_000_000, 2
#: Sources are dealt into blocks of so many; a pair of blocks is evaluated together.
BLOCK = 64
#: Counts of so many pairs of group and term are held by a task before they are handed on.
HELD = 500_000
#: Pairs of blocks whose sums a task holds (32 KB each).
UNITS = 1024
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def term_bounds(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte ranges of the slice's terms; terms first[i]:first[i+1] belong to rows[i]."""
    inside = np.zeros(len(s.data) + 2, bool)
    inside[1:-1] = _LETTER[s.data]
    edge = np.zeros(len(s.data) + 1, bool)  # before these bytes a text begins
    edge[s.bounds] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, s.bounds)


class TermCounts:
    """Counts of (group, term) and of documents with the term, bounded by HELD."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.clear()

    def clear(self) -> None:
        self.terms: dict[bytes, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, column: pa.Array, group: np.ndarray) -> None:
        """Texts of a batch and the numbers of their groups."""
        data, off, _ = text_buffers(column)
        open_row, seen = -1, []  # a text of several slices counts as one document
        for s in slices(data, off):
            starts, ends, first = term_bounds(s)
            names, number = distinct_ranges(_LOWER[s.data], starts, ends)
            ids = np.array([self.terms.setdefault(t, len(self.terms)) for t in names], np.int64)[number] if names else np.empty(0, np.int64)
            rows = np.repeat(s.rows, np.diff(first))
            if len(s.rows) == 1:
                if s.rows[0] != open_row:
                    self._close(open_row, seen, group)
                    open_row, seen = int(s.rows[0]), []
                seen.append(np.unique(ids, return_counts=True))
            else:
                pair, n = np.unique(rows << 32 | ids, return_counts=True)
                self._note(group[pair >> 32] << 32 | pair & 0xFFFFFFFF, n, np.ones(len(n), np.int64))
        self._close(open_row, seen, group)

    def _close(self, row: int, seen: list, group: np.ndarray) -> None:
        if seen:
            ids, back = np.unique(np.concatenate([i for i, _ in seen]), return_inverse=True)
            n = np.bincount(back, np.concatenate([n for _, n in seen]), len(ids)).astype(np.int64)
            self._note(group[row] << 32 | ids, n, np.ones(len(n), np.int64))

    def _note(self, key: np.ndarray, n: np.ndarray, docs: np.ndarray) -> None:
        self.parts.append((key, n, docs))
        self.held += len(key)
        if self.held > 2 * HELD:
            self.merge()

    def merge(self) -> None:
        key, n, docs = (np.concatenate([p[k] for p in self.parts]) if self.parts else np.empty(0, np.int64) for k in range(3))
        key, back = np.unique(key, return_inverse=True)
        self.parts = [(key, *(np.bincount(back, x, len(key)).astype(np.int64) for x in (n, docs)))]
        self.held = len(key)

    def batches(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        terms = pa.array([t.decode() for t in self.terms], pa.string())
        groups = [pa.array([g[k] for g in self.groups], pa.string()) for k in (0, 1)]
        (key, n, docs), self.parts = self.parts[0], []
        for lo in range(0, len(key), 50_000):
            part = slice(lo, lo + 50_000)
            by = pa.array(key[part] >> 32)
            yield pa.RecordBatch.from_arrays([groups[0].take(by), groups[1].take(by), terms.take(pa.array(key[part] & 0xFFFFFFFF)), pa.array(n[part]), pa.array(docs[part])], names=COUNTED)
        self.clear()


COUNTED = ["lang", "source", "term", "n", "docs"]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = TermCounts()
    for batch in batches:
        names = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
        counts.add(batch.column(0), np.array([counts.groups.setdefault(g, len(counts.groups)) for g in names], np.int64))
        if counts.held > HELD:
            counts.merge()
            if counts.held > HELD // 2:
                yield from counts.batches()
    yield from counts.batches()
    langs, sources = ([g[k] for g in counts.groups] for k in (0, 1))
    none = pa.nulls(len(langs))
    zero = pa.array(np.zeros(len(langs), np.int64))
    yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(sources, pa.string()), none.cast(pa.string()), zero, zero], names=COUNTED)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (rows of docs with the term); each group also has a row with null as term. Null lang, source and text read as ''."""
    small_batches(docs.sparkSession)
    rows = pick(docs, text="string", lang="string", source="string").fillna("")
    counted = rows.select("text", "lang", "source").mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, total: str, v: str) -> str:
    """SQL of 1 + floor(SCALE * (n + ADDED) / (total + ADDED * v)), by long division in steps of 1,000, so that nothing leaves 63 bits."""
    of = f"({total} + {ADDED} * {v})"
    one = f"(({n} + {ADDED}) * 1000)"
    two = f"({one} % {of} * 1000)"
    return f"(1 + {one} div {of} * 1000000 + {two} div {of} * 1000 + ({two} % {of} * 1000) div {of})"


def _apart(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div ({p} + {q}))"


def shares(n: np.ndarray, total: np.ndarray, v: int) -> np.ndarray:
    """As _share."""
    of = total + ADDED * v
    out, rest = 0, n + ADDED
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, of)
        out = out * 1000 + digit
    return out + 1


def pair_sums(counts_a: np.ndarray, counts_b: np.ndarray, times: np.ndarray, total_a: np.ndarray, total_b: np.ndarray, v: int) -> np.ndarray:
    """Sums over vectors (rows) of times * floor((p - q)^2 / (p + q)) for each source of a and each of b."""
    p, q = shares(counts_a, total_a, v), shares(counts_b, total_b, v)
    return np.stack([((p[:, i : i + 1] - q) ** 2 // (p[:, i : i + 1] + q) * times[:, None]).sum(axis=0) for i in range(p.shape[1])])


def _dense(column: pa.Array, rows: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    some = column.take(pa.array(rows))
    flat = some.flatten()
    line = np.repeat(np.arange(len(rows)), np.asarray(some.value_lengths()))
    out[line, flat.field("i").to_numpy(zero_copy_only=False)] = flat.field("n").to_numpy(zero_copy_only=False)
    return out


def _evaluated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple, list] = {}

    def out() -> pa.RecordBatch:
        cols: list[list] = [[] for _ in range(5)]
        for (lang, a, b), (m, covered) in sums.items():
            i, j = np.indices(m.shape).reshape(2, -1)
            i, j = i + a * BLOCK, j + b * BLOCK
            ok = i < j
            for c, x in zip(cols, ([lang] * int(ok.sum()), i[ok], j[ok], m.ravel()[ok], np.full(int(ok.sum()), covered)), strict=True):
                c.extend(x)
        sums.clear()
        types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["lang", "i", "j", "value", "covered"])

    for batch in batches:
        units: dict[tuple, list[int]] = {}
        for row, unit in enumerate(zip(*(batch.column(n).to_pylist() for n in ("lang", "a", "b")), strict=True)):
            units.setdefault(unit, []).append(row)
        times = batch.column("times").to_numpy()
        for unit, rows in units.items():
            rows = np.array(rows)
            total_a, total_b = (np.array(batch.column(n)[int(rows[0])].as_py(), np.int64) for n in ("total_a", "total_b"))
            counts = [_dense(batch.column(n), rows, len(t)) for n, t in (("vec_a", total_a), ("vec_b", total_b))]
            found = pair_sums(*counts, times[rows], total_a, total_b, batch.column("v")[int(rows[0])].as_py())
            held = sums.setdefault(unit, [np.zeros_like(found), 0])
            held[0] += found
            held[1] += int(times[rows].sum())
        if len(sums) > UNITS:
            yield out()
    yield out()


def _pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, i < j, value of each pair of a language's groups."""
    entry = "array<struct<i:int,n:bigint>>"
    vectors = terms.groupBy("lang", "vec").agg(F.count(F.lit(1)).alias("times"))
    blocks = groups.groupBy("lang", F.expr(f"i div {BLOCK}").cast("int").alias("b")).agg(F.array_sort(F.collect_list(F.struct("i", "total"))).alias("t"), F.first("v").alias("v"))
    blocks = stored(blocks.select("lang", "b", F.transform("t", lambda x: x.total).alias("total"), "v"), "source-blocks")
    many = blocks.groupBy("lang").agg(F.count(F.lit(1)).alias("blocks"))
    spread = "array_distinct(flatten(transform(array_distinct(transform(vec, x -> cast(x.i div {b} AS int))), p -> transform(sequence(0, cast(blocks AS int) - 1), q -> struct(least(p, q) AS a, greatest(p, q) AS b)))))"
    units = join_checked(vectors, many, "lang").select("lang", "vec", "times", F.explode(F.expr(spread.format(b=BLOCK))).alias("u")).select("lang", "u.*", "vec", "times")
    part = lambda x: F.expr(f"transform(filter(vec, e -> e.i div {BLOCK} = {x}), e -> struct(cast(e.i - {BLOCK} * {x} AS int) AS i, e.n AS n))").cast(entry)
    units = units.select("lang", "a", "b", part("a").alias("vec_a"), part("b").alias("vec_b"), "times").groupBy("lang", "a", "b", "vec_a", "vec_b").agg(F.sum("times").alias("times"))
    units = join_checked(units, blocks.select("lang", F.col("b").alias("a"), F.col("total").alias("total_a"), "v"), ["lang", "a"])
    units = join_checked(units, blocks.select("lang", "b", F.col("total").alias("total_b")), ["lang", "b"])
    sums = units.mapInArrow(_evaluated, "lang string, i int, j int, value long, covered long").groupBy("lang", "i", "j").agg(F.sum("value").alias("value"), F.sum("covered").alias("covered"))
    x, y = (groups.select("lang", F.col("i").alias(k), F.col("source").alias(f"source_{k}"), F.col("total").alias(f"total_{k}"), *(["v"] if k == "i" else [])) for k in ("i", "j"))
    every = x.join(y, "lang").where("i < j").join(sums, ["lang", "i", "j"], "left")  # the rows of the result
    rest = f"(v - coalesce(covered, 0)) * if(v > 0, {_apart(_share('0', 'total_i', 'v'), _share('0', 'total_j', 'v'))}, 0)"  # terms that neither has
    return every.select("lang", "source_i", "source_j", F.expr(f"coalesce(value, 0) + if(v > coalesce(covered, 0), {rest}, 0)").cast("long").alias("value"))


def source_audit(docs: DataFrame, least_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language is from each other one (part `pair`, all), and its
    most overused terms against the whole language (part `term`, `top` of them).

    A language keeps the terms that at least `least_docs` of its documents hold. A source without terms, also of a language that keeps none,
    has its pairs (value 0 if none is kept); a source alone in its language has none. Null text, lang and source read as ''; repeated rows
    count each; an empty table gives an empty result; other columns are ignored. Whole numbers stay exact below 9e15 words of a language.
    """
    counts = stored(term_counts(docs), "term-counts")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    named = stored(counts.where("term IS NULL").select("lang", "source").withColumn("i", place), "sources")  # a row for each group
    own = join_checked(counts.where("term IS NOT NULL"), named, ["lang", "source"])
    vec = F.array_sort(F.collect_list(F.struct("i", "n"))).alias("vec")  # one entry for each source at most
    terms = own.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang"), vec)
    terms = stored(terms.where(F.col("docs") >= least_docs).drop("docs"), "term-vectors")
    each = terms.select("lang", "term", "n_lang", F.explode("vec").alias("e")).select("lang", "term", "n_lang", "e.*")
    sizes = each.groupBy("lang", "i").agg(F.sum("n").alias("total"))
    whole = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n_lang").alias("total_lang"))
    groups = named.join(sizes, ["lang", "i"], "left").join(whole, "lang", "left").fillna(0, ["total", "v", "total_lang"])
    groups = stored(groups, "source-sizes")

    pairs = _pairs(terms, groups)
    way = lambda a, b: F.struct(F.col(a).alias("source"), F.col(b).alias("item"))
    pairs = pairs.select("lang", F.explode(F.array(way("source_i", "source_j"), way("source_j", "source_i"))).alias("w"), "value").select("lang", "w.*", F.lit("pair").alias("part"), "value")

    p = join_checked(each, groups, ["lang", "i"]).select("lang", "source", F.col("term").alias("item"), F.expr(_share("n", "total", "v")).alias("p"), F.expr(_share("n_lang", "total_lang", "v")).alias("q"))
    used = p.where("p > q").select("lang", "source", "item", F.lit("term").alias("part"), F.expr(_apart("p", "q")).alias("value"))
    rank: Column = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    both = pairs.withColumn("rank", rank).unionByName(used.withColumn("rank", rank).where(F.col("rank") <= top))
    return both.select("lang", "source", "part", "item", "value", "rank")


_SQL_P = f"1 + ({SCALE}::HUGEINT * (n + {ADDED})) // (t + {ADDED} * v)"
#: All terms by all sources in SQL.
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS id, translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '{PATTERN}')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 10),
vs AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
f AS (SELECT g.lang, g.source, k.term, COALESCE(c.n, 0) AS n FROM g JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT lang, source, term, n, {_SQL_P} AS p FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS t FROM f) JOIN vs USING (lang)),
q AS (SELECT lang, term, {_SQL_P} AS q FROM (SELECT *, sum(n) OVER (PARTITION BY lang) AS t FROM (SELECT lang, term, sum(n) AS n FROM f GROUP BY ALL)) JOIN vs USING (lang)),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, COALESCE(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM r QUALIFY part = 'pair' OR rank <= 10
"""
