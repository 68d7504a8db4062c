"""Exact Jaccard self-join of five-word shingle sets: a grouped prefix join.

1. Every text becomes its set of distinct five-word shingles, as 64-bit hashes. Equal sets form a class.
2. Shingles have one global order: those found often (counted over all texts) come last, the rest stand by
   hash. Two sets that are similar enough share a shingle among the first n - ceil(t * n) + 1 of each, its prefix.
3. Classes with the same prefix and size are collapsed into one group. A posting links a prefix shingle to a group.
4. Neighbours in a posting list, ordered by size, are candidate pairs; length and position filters drop most. Groups are expanded
   into classes. A sketch of each set, the number of its shingles in each of 256 ranges of hashes, bounds a pair's intersection
   from above; pairs that it leaves are verified on their whole sets. Verified links give components.
5. In lists that are not one component yet, classes outside the list's main component meet more and more classes of other components,
   at last all that pass the filters (`link_lists`). Lists that lie in one component, as those of many near copies do, give no
   pair, so no list is expanded into all its pairs.

Hashes of 64 bits stand for shingles; two different shingles of one pair of texts agree with probability below 1e-13.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociq.llm.common import pick, released, small_batches, stored
from lociq.llm.graph import link_lists
from lociq.llm.words import mix64, range_hashes, slices, text_buffers, word_bounds
from lociq.storage import scratch

WORDS = 5
#: A similarity of 3/4: 100 * intersection >= 75 * union.
NUMERATOR, DENOMINATOR = 3, 4
#: At most so many frequent shingles are sent to the tasks (5 bytes each); the commonest are. They set the order, not the result.
FREQUENT = 1_000_000
#: Ranges of hashes that a sketch counts.
SKETCH = 256
#: Shingles that a task holds while it counts.
WINDOW = 2_000_000
#: Parts into which the posting list of a frequent shingle is dealt.
SALTS = 64
#: Candidate classes up to this number are looked up by a broadcast of their rows' keys (24 bytes each), more by a shuffle.
FEW_IDS = 300_000
_MULT = (np.random.default_rng(5).integers(0, 1 << 63, 16, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def shingle_sets(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(flat, offsets): for each text the sorted distinct hashes of its shingles."""
    data, off, _ = text_buffers(column)
    n = len(off) - 1
    hashes, per_row = [], np.zeros(n, np.int64)
    for s in slices(data, off):
        starts, ends, first = word_bounds(s)
        hashes.append(range_hashes(s.data, starts, ends, lower=True)[0])
        per_row[s.rows] += np.diff(first)
    w = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    count = max(0, len(w) - words + 1)
    rolled = np.zeros(count, np.uint64)
    for k in range(words if count else 0):
        rolled += w[k : k + count] * _MULT[k]
    rolled = mix64(rolled)
    at = np.concatenate(([0], np.cumsum(per_row)))
    sets = []
    for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if z - a >= words:
            sets.append(np.unique(rolled[a : z - words + 1]))
        elif z > a:  # fewer words: the whole sequence is the only shingle
            sets.append(mix64((w[a:z] * _MULT[: z - a]).sum(dtype=np.uint64, keepdims=True) + _MULT[15 - (z - a)]))
        else:
            sets.append(w[:0])
    flat = np.concatenate(sets) if sets else w[:0]
    return flat, np.concatenate(([0], np.cumsum([len(x) for x in sets], dtype=np.int64)))


def set_digests(flat: np.ndarray, off: np.ndarray) -> np.ndarray:
    """16 bytes for each set, the same for equal sets."""
    out = np.zeros((len(off) - 1, 2), np.uint64)
    full = np.diff(off) > 0
    if full.any():
        for k in (0, 1):
            out[full, k] = np.add.reduceat(mix64(flat ^ _MULT[5 + k]), off[:-1][full])
    return out


def prefix_size(n: int) -> int:
    return n - -(-n * NUMERATOR // DENOMINATOR) + 1


@released
def _recurring(batches: Iterator[pa.RecordBatch], words: int, window: int) -> Iterator[pa.RecordBatch]:
    """Shingles that more than one text of a window has, with the number of such texts; a class counts once."""
    held: list[np.ndarray] = []
    seen: set[bytes] = set()
    size = 0

    def counted() -> pa.RecordBatch:
        token, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(token[n > 1].view(np.int64)), pa.array(n[n > 1].astype(np.int64))], names=["token", "n"])

    for batch in batches:
        flat, off = shingle_sets(batch.column(0), words)
        for k, d in enumerate(set_digests(flat, off)):
            key = d.tobytes()
            if key not in seen and off[k + 1] > off[k]:
                seen.add(key)
                held.append(flat[off[k] : off[k + 1]])
                size += len(held[-1])
        if size >= window:
            yield counted()
            held, size, seen = [], 0, set()
    if held:
        yield counted()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Five bytes for each row instead of a row."""
    for batch in batches:
        upper, step = batch.column(0).to_numpy(zero_copy_only=False).astype("<u4"), batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([upper.tobytes()], pa.binary()), pa.array([step.tobytes()], pa.binary())], names=["upper", "step"])


def frequent_shingles(rows: DataFrame, words: int = WORDS, most: int = FREQUENT, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(upper 32 bits of the hash, step of the count) of the commonest recurring shingles over all rows, sorted; at most `most`.

    Shingles with the same upper bits count together: any order that depends on the shingle alone will do.
    """
    found = rows.select("text").mapInArrow(partial(_recurring, words=words, window=window), "token long, n long")
    counts = found.groupBy(F.shiftrightunsigned("token", 32).alias("upper")).agg(F.sum("n").alias("n"))
    counts = stored(counts.select("upper", F.least(F.floor(F.log2("n") * 8), F.lit(255)).cast("int").alias("step")), "shingle-counts")
    least, total, share = 256, 0, 0.0
    for step, many in sorted(map(tuple, counts.groupBy("step").count().collect()), reverse=True):  # a histogram keeps the table near its bound
        if total + many > most:
            share = (most - total) / many  # of the last step, those with the smallest hashes
            break
        least, total = step, total + many
    kept = (F.col("step") >= least) | ((F.col("step") == least - 1) & (F.pmod(F.xxhash64("upper"), F.lit(1 << 20)) < int(share * (1 << 20))))
    packed = counts.where(kept).mapInArrow(_packed, "upper binary, step binary").collect()
    if not packed:
        return np.empty(0, np.uint32), np.empty(0, np.uint8)
    upper = np.concatenate([np.frombuffer(r[0], "<u4") for r in packed])
    order = np.argsort(upper)
    return upper[order], np.concatenate([np.frombuffer(r[1], np.uint8) for r in packed])[order]


_SIGNATURE = "doc_id long, rid long, text_hash long, cls binary, n int, gkey long, prefix array<long>, hot_from int"


@released
def _signatures(batches: Iterator[pa.RecordBatch], words: int, frequent) -> Iterator[pa.RecordBatch]:
    """Class, size, group and, at a group's first row in this task, its prefix."""
    common, count = frequent.value
    seen: set[int] = set()
    for batch in batches:
        flat, off = shingle_sets(batch.column(3), words)
        digests = set_digests(flat, off)
        upper = (flat >> np.uint64(32)).astype(np.uint32)
        at = np.minimum(np.searchsorted(common, upper), max(len(common) - 1, 0))
        often = common[at] == upper if len(common) else np.zeros(len(flat), bool)
        out: dict[str, list] = {c: [] for c in ("cls", "gkey", "prefix", "hot_from")}
        for k, (a, z) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
            if a == z:
                for column in out.values():
                    column.append(None)
                continue
            p = prefix_size(z - a)
            rare, hot = flat[a:z][~often[a:z]][:p], np.empty(0, np.uint64)
            if len(rare) < p:
                mine, n = flat[a:z][often[a:z]], count[at[a:z]][often[a:z]]
                hot = mine[np.lexsort((mine, n))][: p - len(rare)]
            prefix = np.concatenate((rare, hot))
            group = int(mix64(np.array([(mix64(prefix) * _MULT[7]).sum(dtype=np.uint64) + np.uint64(z - a)], np.uint64)).view(np.int64)[0])
            known = group in seen
            if not known:
                if len(seen) > 2_000_000:
                    seen.clear()
                seen.add(group)
            out["cls"].append(digests[k].tobytes())
            out["gkey"].append(group)
            out["prefix"].append(None if known else prefix.view(np.int64))
            out["hot_from"].append(len(rare))
        columns = [pa.array(out[c], t) for c, t in (("gkey", pa.int64()), ("prefix", pa.list_(pa.int64())), ("hot_from", pa.int32()))]
        mine = [*batch.columns[:3], pa.array(out["cls"], pa.binary()), pa.array(np.diff(off).astype(np.int32))]
        yield pa.RecordBatch.from_arrays([*mine, *columns], names=["doc_id", "rid", "text_hash", "cls", "n", "gkey", "prefix", "hot_from"])


@released
def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches allow an intersection that is large enough."""
    as_counts = lambda x: np.frombuffer(x, "u1" if len(x) == SKETCH else "<u4").astype(np.int64)
    for batch in batches:
        ok = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
            p, q = as_counts(x), as_counts(y)
            ok.append(int(np.minimum(p, q).sum()) * (NUMERATOR + DENOMINATOR) >= int(p.sum() + q.sum()) * NUMERATOR)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _range(n: Column, pos: Column) -> tuple[Column, Column]:
    """(lo, hi): sizes of sets that may be similar to one of size n whose first common shingle is at pos.

    An intersection of at least t * (n + m - intersection) needs m >= t * n, and n - pos >= t / (1 + t) * (n + m).
    """
    hi = F.floor((n - pos) * (NUMERATOR + DENOMINATOR) / NUMERATOR) - n
    return F.ceil(n * NUMERATOR / DENOMINATOR).cast("int").alias("lo"), hi.cast("int").alias("hi")


@released
def _of_class(batches: Iterator[pa.RecordBatch], words: int, sketched: bool) -> Iterator[pa.RecordBatch]:
    """Sets, or their sketches, of the texts that are of the class asked for (a key may stand for several texts); each once in a task."""
    seen: set[bytes] = set()
    for batch in batches:
        flat, off = shingle_sets(batch.column(1), words)
        mine = []
        for c, d in zip(batch.column(0).to_pylist(), map(np.ndarray.tobytes, set_digests(flat, off)), strict=True):
            mine.append(c == d and c not in seen)
            seen.add(d)
        if sketched:
            tallies = [np.bincount((flat[a:z] >> np.uint64(56)).astype(np.int64), minlength=SKETCH) for a, z in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            found = pa.array([t.astype("<u4" if t.max() > 255 else "u1").tobytes() for t in tallies], pa.binary())
        else:
            found = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(flat.view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["cls", "found"]).filter(pa.array(mine, pa.bool_()))


def _both_found(pairs: DataFrame, classes: DataFrame, rows: DataFrame, words: int, sketched: bool) -> DataFrame:
    """a, b, x, y: pairs with both sets, or sketches, made anew from the texts of their classes."""
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct().join(classes.select("cls", "rep"), "cls")
    wanted = stored(wanted.select(F.col("rep").alias("rid"), "cls"), "wanted")
    texts = rows.join(F.broadcast(wanted) if wanted.count() <= FEW_IDS else wanted, "rid").select("cls", "text")
    found = texts.mapInArrow(partial(_of_class, words=words, sketched=sketched), f"cls binary, found {'binary' if sketched else 'array<long>'}")
    found = stored(found, "sketches" if sketched else "sets")
    left, right = found.select(F.col("cls").alias("a"), F.col("found").alias("x")), found.select(F.col("cls").alias("b"), F.col("found").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")


def _verified(pairs: DataFrame, classes: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """The pairs that are similar enough: by sketches of their sets first; only classes of pairs that these leave have their sets compared."""
    sketched = _both_found(pairs, classes, rows, words, sketched=True)
    likely = stored(sketched.mapInArrow(_plausible, "a binary, b binary").distinct(), "likely")
    both = F.size(F.array_intersect("x", "y"))
    ok = both * (NUMERATOR + DENOMINATOR) >= (F.size("x") + F.size("y")) * NUMERATOR
    return _both_found(likely, classes, rows, words, sketched=False).where(ok).select("a", "b")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, rid, text_hash, text: rid finds a row's text again; without a doc_id it is the text's hash."""
    rows = pick(docs, doc_id="long", text="string").withColumn("text_hash", F.xxhash64("text"))
    return rows.select("doc_id", F.coalesce("doc_id", "text_hash").alias("rid"), "text_hash", "text")


def jaccard_classes(docs: DataFrame, words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(members, labels).

    members: doc_id, text_hash, n_shingles, cls, one row per row of docs; cls is null for a text that is null or has no words. labels: cls, label,
    where classes that similar pairs connect have one label; classes without a similar one are left out.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = _keyed(docs)
    frequent = spark.sparkContext.broadcast(frequent_shingles(rows, words))
    sig = stored(rows.mapInArrow(partial(_signatures, words=words, frequent=frequent), _SIGNATURE), "signatures")

    # posting lists of groups, the frequent shingles' in parts; rows without another group of a fitting size end here. `place` is size, position and a mark.
    posts = sig.where("prefix IS NOT NULL").select("gkey", "n", "hot_from", F.posexplode("prefix").alias("pos", "token"))
    hot = F.col("pos") >= F.col("hot_from")
    part = F.pmod(F.xxhash64("gkey"), F.lit(SALTS)) + 1
    key = F.when(hot, F.col("token").bitwiseXOR(F.xxhash64(part))).otherwise(F.col("token"))
    place = F.shiftleft(F.col("n").cast("long"), 32) + F.shiftleft(F.col("pos").cast("long"), 1) + hot.cast("long")
    w = Window.partitionBy("key").orderBy("place", "gkey")
    lists = posts.select(key.alias("key"), "gkey", place.alias("place")).select("*", *[f(c).over(w).alias(f"{c}{end}") for f, end in ((F.lag, "_before"), (F.lead, "_after")) for c in ("gkey", "place")])
    size = lambda c: F.shiftright(c, 32)
    # a list stands by size: if the next other groups are too small and too large, so are all others
    fits = lambda small, large: size(small) * DENOMINATOR >= size(large) * NUMERATOR
    meets = lambda c, ok: F.coalesce((F.col(c) != F.col("gkey")) & ok, F.lit(False))
    hot = F.col("place").bitwiseAND(F.lit(1)) == 1
    lists = lists.where(hot | meets("gkey_before", fits("place_before", "place")) | meets("gkey_after", fits("place", "place_after")))
    token = F.when(hot, F.col("key").bitwiseXOR(F.xxhash64(part))).otherwise(F.col("key"))
    pos = F.shiftright(F.col("place"), 1).bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    lists = stored(lists.select(token.alias("token"), F.when(hot, part).otherwise(0).cast("int").alias("salt"), "gkey", pos.alias("pos")), "postings")

    # groups are expanded into their classes; a group of several classes is a list of its own
    classes = stored(sig.where("cls IS NOT NULL").groupBy("cls").agg(F.min("rid").alias("rep"), F.min("n").alias("n"), F.min("gkey").alias("gkey")), "classes")
    crowded = classes.groupBy("gkey").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("gkey")
    within = classes.join(crowded, "gkey").select(F.col("gkey").alias("token"), (F.pmod(F.xxhash64("cls"), F.lit(SALTS)) + 1).cast("int").alias("salt"), "cls", "n", F.lit(0).alias("pos"))
    met = lists.join(classes.select("gkey", "cls", "n"), "gkey").select("token", "salt", "cls", "n", "pos").unionByName(within)
    met = stored(met.select("token", "salt", "cls", "n", *_range(F.col("n"), F.col("pos"))), "class-postings")

    labels = link_lists(met, partial(_verified, classes=classes, rows=rows, words=words))
    return sig.select("doc_id", "text_hash", F.col("n").cast("long").alias("n_shingles"), "cls"), labels


def jaccard_components(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs.

    component_id is the smallest doc_id that links of similar texts reach. A text that is null or has no word has no shingles and
    links with nothing; its component_id is its doc_id. Rows with a null doc_id are kept and linked, and the component takes
    the smallest doc_id that is not null (null if there is none). Rows that repeat a doc_id are rows of their own. An empty table gives an empty result. Other columns are ignored.
    """
    with scratch(docs.sparkSession, "signatures", "class-components"):
        members, labels = jaccard_classes(docs, words)
        found = labels.withColumnRenamed("label", "root")
        by_class = members.where("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("rep"))
        rooted = by_class.join(found, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        smallest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
        by_class = stored(rooted.join(smallest, "root").select("cls", "component_id"), "class-components")
    out = members.join(by_class, "cls", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row of docs, with all its columns, for each component: the one with the smallest doc_id (null last), then the smallest hash of its text.

    Of rows that agree in doc_id and text one stays, whichever columns else they differ in. A text that is null or has no word is
    a component of its own, so such a row stays unless it repeats another one's doc_id and text.
    """
    with scratch(docs.sparkSession, "kept"):  # the rows come from docs by the stored keys alone
        members, labels = jaccard_classes(docs, words)
        return kept_rows(docs, members, labels)


def kept_rows(docs: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that one_of_each keeps, by the result of jaccard_classes."""
    names = list(docs.columns)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    roots = members.where("cls IS NOT NULL").groupBy("cls").agg(first).join(labels, "cls", "left")
    keep = roots.groupBy(F.coalesce("label", "cls").alias("root")).agg(F.min("first").alias("first")).select("first.doc_id", "first.text_hash")
    alone = members.where("cls IS NULL").select("doc_id", "text_hash")
    keep = stored(keep.unionByName(alone).distinct().select(F.col("doc_id").alias("keep_id"), F.col("text_hash").alias("keep_hash")), "kept")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    have = {c.lower(): c for c in names}
    get = lambda c, t: F.col("row").getField(have[c]).cast(t) if c in have else F.lit(None).cast(t)
    row = row.select("row", get("doc_id", "long").alias("keep_id"), F.xxhash64(get("text", "string")).alias("keep_hash"))
    same = row["keep_id"].eqNullSafe(keep["keep_id"]) & (row["keep_hash"] == keep["keep_hash"])
    one = row.join(keep, same, "left_semi").withColumn("turn", F.row_number().over(Window.partitionBy("keep_id", "keep_hash").orderBy(F.lit(0))))
    return one.where("turn = 1").select("row.*")
