"""Short alignments between flanks and noncoding regions (guides), by column expressions alone.

One expression made of a flank's windows, read either way, marks the places of a noncoding stretch at which one of them begins. They become seeds;
a seed's row has all that it grows by, and only finished hits are shuffled, by key and orientation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociq.functions.sequence import revcomp

FORWARD, REVERSE = "forward", "reverse_complement"
#: Windows in a piece of a stretch, and pieces in a block of it.
PIECE, PIECES = 64, 64
#: Letters of the stretches that a task searches, about: its seeds and hits are sorted by the task, so they must not grow with the table.
LETTERS = 4 << 20
#: SQL that turns a text into an expression for it: a backslash before what is neither letter nor digit.
_PLAIN = r"regexp_replace({}, '[^A-Za-z0-9]', '\\\\$0')"


def _held(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns set that are computed once for each row: expressions that use them are not merged with theirs."""
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _let(name: str, value: str, body: str) -> str:
    """SQL of body with value, computed once, under a name."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _marks(k: int) -> str:
    """SQL of the expression for a letter at which a window of k letters of a or ra begins: windows by their first letters, so that few are tried at a place."""
    windows = "array_distinct(concat({}))".format(", ".join(f"transform(sequence(1, length({t}) - {k - 1}), x -> substr({t}, x, {k}))" for t in ("a", "ra")))
    first = f"cast(least({k}, greatest(1, round(log(4, 2 * length(a)) / 2))) AS int)"  # as many beginnings as windows to each, about
    plain = lambda t: f"if(o.odd, {_PLAIN.format(t)}, {t})"
    begins = "concat(if(t = 0, '', ')|'), {}, '(?:', {})".format(plain("left(w, o.n)"), plain("substr(w, o.n + 1)"))
    each = "transform(o.w, (w, t) -> if(t > 0 AND startswith(w, left(get(o.w, t - 1), o.n)), concat('|', {}), {}))".format(plain("substr(w, o.n + 1)"), begins)
    return _let("o", f"struct(sort_array({windows}) AS w, {first} AS n, concat(a, ra) RLIKE '[^A-Za-z0-9]' AS odd)", f"concat('(?s)(?=', array_join({each}, ''), ')).')")


def _seeds(pairs: DataFrame, k: int, keep_first: bool) -> DataFrame:
    """key, a, b, i, j, rc, base of windows of k letters; with keep_first a forward one only where its run of equal letters begins.

    b and j are the part of the stretch that a hit can reach (as far as the flank is long) and the window's place in it; it begins at base.
    """
    size = PIECE * PIECES
    work = _held(pairs.select("key", "flank_seq", "nc_seq"), a=F.upper("flank_seq"), b=F.upper("nc_seq"))  # made once, whatever made the sequences
    work = _held(work.where(f"length(a) >= {k} AND length(b) >= {k}").select("key", "a", "b"), ra=revcomp(F.col("a")), last=F.length("b") - k)
    work = _held(work, marks=F.expr(_marks(k)), m=F.length("a")).withColumn("g", F.explode(F.expr(f"sequence(0, last div {size})")))
    work = _held(work, g=F.expr(f"cast(g * {size} AS int)"), off=F.expr(f"cast(greatest(g * {size} - m, 0) AS int)"))
    work = _held(work, block=F.expr(f"substr(b, off + 1, {size + k} + 2 * m)"), mask=F.expr(f"regexp_replace(substr(b, g + 1, {size + k - 1}), marks, 'x')")).drop("b", "marks")
    work = work.withColumn("c", F.explode(F.expr(f"sequence(0, least({PIECES - 1}, (last - g) div {PIECE}))")))
    work = _held(work, at=F.expr(f"cast(g + c * {PIECE} AS int)"), mask=F.expr(f"substr(mask, c * {PIECE} + 1, {PIECE})")).where("contains(mask, 'x')")  # no small letter is left by upper
    work = _held(work, lo=F.expr("greatest(at - m, 0)"), piece=F.expr(f"substr(block, greatest(at - m, 0) - off + 1, {PIECE + k} + 2 * m)")).drop("block")  # all that hits can reach: places in long texts are found letter by letter
    work = work.withColumn("o", F.explode(F.expr("sequence(0, length(mask) - 1)"))).where("substr(mask, o + 1, 1) = 'x'").withColumn("j", F.expr("at + o"))
    work = _held(work, w=F.expr(f"substr(piece, j - lo + 1, {k})")).withColumn("rc", F.explode(F.expr("array(false, true)")))
    work = _held(work, side=F.expr("if(rc, ra, a)"), one=F.expr("locate(w, if(rc, ra, a))")).where("one > 0")
    work = work.withColumn("t", F.explode(F.expr(f"if(locate(w, side, one + 1) = 0, array(one), sequence(one, m - {k - 1}))"))).where(f"substr(side, t, {k}) = w")
    found = work.withColumn("i", F.expr(f"if(rc, m - {k - 1} - t, t - 1)"))
    if keep_first:
        found = found.where("rc OR i = 0 OR j = 0 OR substr(a, i, 1) <> substr(piece, j - lo, 1)")
    local = F.expr(f"substr(piece, j - lo + 1 - least(j, m), least(j, m) + m + {k})").alias("b")
    return found.select("key", "a", local, "i", F.expr("least(j, m)").alias("j"), "rc", F.expr("j - least(j, m)").alias("base"))


def guide_seeds(pairs: DataFrame, k: int = 9) -> DataFrame:
    """key, pos1, pos2, orientation of the exact k-mer matches, forward and reverse complement, of columns flank_seq and nc_seq of each key.

    A row holds both sequences, so matches are found within it and nothing is shuffled. Nulls and sequences below k letters give none.
    """
    return _seeds(pairs, k, False).select("key", F.col("i").alias("pos1"), (F.col("base") + F.col("j")).alias("pos2"), F.when(F.col("rc"), REVERSE).otherwise(FORWARD).alias("orientation"))


def tiered(length: Column, mismatches: Column, allowed: int = 1, exact: int = 9, inexact: int = 12) -> Column:
    """Whether a hit is long enough for its mismatches."""
    return ((mismatches == 0) & (length >= exact)) | ((mismatches <= allowed) & (length >= inexact))


def _alike(x: str, y: str) -> str:
    """SQL of the length of the common beginning of two texts of one length: steps of halved lengths, taken where the letters under them are equal."""
    steps = "transform(reverse(sequence(0, length(bin(o.n)) - 1)), e -> shiftleft(1, e))"
    walk = f"aggregate({steps}, 0, (n, s) -> if(n + s <= o.n AND substr(o.x, n + 1, s) = substr(o.y, n + 1, s), n + s, n))"
    return _let("o", f"struct({x} AS x, {y} AS y, length({x}) AS n)", f"if(o.x = o.y, o.n, {walk})")


def _grown_forward(k: int, allowed: int) -> str:
    """Runs of equal letters: to the right over up to `allowed` mismatches, then to the left over those that are left.

    Places do not move against each other, so all seeds of a run grow to the same hit.
    """
    last = "least(length(a) - i, length(b) - j)"
    ahead = lambda n: _alike(*[f"substr({t}, {at} + {n} + 1, {last} - ({n}))" for t, at in (("a", "i"), ("b", "j"))])
    before = _alike(*[f"reverse(substr({t}, h.{at} - least(h.i, h.j) + 1, least(h.i, h.j) - 1))" for t, at in (("a", "i"), ("b", "j"))])
    right = f"if(h.n < {last}, struct(h.i AS i, h.j AS j, h.n + 1 + {ahead('h.n + 1')} AS n, array_append(h.bad, i + h.n) AS bad), h)"
    left = f"if(size(h.bad) < {allowed} AND h.i > 0 AND h.j > 0, {_let('s', f'1 + {before}', 'struct(h.i - s AS i, h.j - s AS j, h.n + s AS n, array_append(h.bad, h.i - 1) AS bad)')}, h)"
    grown = f"struct(i AS i, j AS j, {k} + {ahead(str(k))} AS n, cast(array() AS array<int>) AS bad)"
    for step in [right] * allowed + [left] * allowed:
        grown = _let("h", grown, step)
    return _let("h", grown, "struct(h.i AS i, h.j AS j, h.n AS n, sort_array(transform(h.bad, p -> p - h.i)) AS bad)")


def _near(x: str, y: str, n: str, allowed: int) -> str:
    """SQL that holds if texts of n letters may differ in few enough: cut into one stretch more than may differ, one is alike. Most seeds end here, before letters are listed."""
    at = lambda p: f"cast({n} * {p} div {allowed + 1} AS int)"
    cut = lambda t, p: f"substr({t}, {at(p)} + 1, {at(p + 1)} - {at(p)})"
    return "(" + " OR ".join(f"{cut(x, p)} = {cut(y, p)}" for p in range(allowed + 1)) + ")"


def _grown_reverse(k: int, allowed: int) -> str:
    """Reverse-complement seeds: to the right and then to the left while at most `allowed` letters differ.

    Both ends move alike, as in the forward case, so a match loses its register when it grows, and each step compares anew.
    """
    letters = lambda i, j, n: (f"substr(a, {i} + 1, {n})", f"substr(rb, length(b) - ({j}) - ({n}) + 1, {n})")
    unlike = "zip_with(split(o.x, ''), split(o.y, ''), (p, q) -> p <> q)"
    few = lambda i, j, n: _let("o", "struct({} AS x, {} AS y)".format(*letters(i, j, n)), f"{_near('o.x', 'o.y', 'length(o.x)', allowed)} AND size(filter({unlike}, z -> z)) <= {allowed}")
    # steps taken so far; -1 - steps once one failed, as that is cheap to carry on
    grow = lambda room, i, j, n: f"aggregate(sequence(1, 1 + {room}), 0, (s, t) -> if(s < 0, s, if(t <= {room} AND {few(i, j, n)}, s + 1, -1 - s)), s -> -1 - s)"
    right = grow(f"greatest(0, least(length(a) - i, length(b) - j) - {k})", "i", "j", f"({k} + s + 1)")
    left = grow("least(i, j)", "(i - s - 1)", "(j - s - 1)", "(r + s + 1)")
    bad = _let("o", "struct({} AS x, {} AS y)".format(*letters("h.i", "h.j", "h.n")), f"if(o.x = o.y, cast(array() AS array<int>), transform(filter(transform({unlike}, (d, t) -> struct(d AS d, t AS t)), z -> z.d), z -> z.t))")
    hit = _let("h", "struct(i - l AS i, j - l AS j, r + l AS n)", f"struct(h.i AS i, h.j AS j, h.n AS n, {bad} AS bad)")
    return _let("rb", "reverse(translate(b, 'ACGTacgt', 'TGCAtgca'))", _let("r", f"{k} + {right}", _let("l", left, hit)))


def _stays(k: int, allowed: int) -> str:
    """SQL that holds if a reverse-complement seed can't grow at either end, told by its windows and their neighbours alone."""
    side = lambda d: _near(f"substr(a, i + {1 - d}, {k + 1})", f"reverse(translate(substr(b, j + {1 - d}, {k + 1}), 'ACGTacgt', 'TGCAtgca'))", str(k + 1), allowed)
    return f"rc AND NOT (least(length(a) - i, length(b) - j) > {k} AND {side(0)}) AND NOT (least(i, j) > 0 AND {side(1)})"


def dealt(pairs: DataFrame, parts: int) -> DataFrame:
    """pairs dealt to so many tasks by key: for tables of fewer splits than cores, as windows cost far more time than their bytes tell."""
    return pairs.repartition(parts, "key")


def parts_of(letters: int | None, cores: int) -> int:
    """Tasks to deal stretches of so many letters to: four for each core at least, and as many as LETTERS asks for, whatever the number of cores."""
    return max(4 * cores, -(-(letters or 0) // LETTERS))


def _islands(hits: DataFrame) -> DataFrame:
    """hits with island: of a key and orientation, hits on different islands have no letter of the stretch in common, so none bars one of another."""
    by = Window.partitionBy("key", "rc").orderBy("j")
    before = F.max(F.col("j") + F.col("n")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    return hits.withColumn("begins", F.when(F.col("j") < before, 0).otherwise(1)).withColumn("island", F.sum("begins").over(by.rowsBetween(Window.unboundedPreceding, 0))).drop("begins")


def _chosen(hits: DataFrame) -> DataFrame:
    """key, rc, h of the greedy choice: hits in order, but for those that overlap an earlier one on both sides.

    What is kept lies in cells by its first place on the stretch. A cell is as long as the island's longest hit, so a hit looks into three
    cells of its island and not at all that is kept. Hits are collected without what follows from the rest: y only where it is not x.
    """
    order = F.struct((-F.col("n")).alias("first"), F.size("bad").alias("wrong"), "seed", "i", "j", "bad", "x", F.when(F.col("x") != F.col("y"), F.col("y")).alias("y"))
    each = hits.groupBy("key", "rc", "island").agg(F.sort_array(F.collect_list(order)).alias("h"), F.min("j").alias("low"), F.max("j").alias("high"), F.max("n").alias("size"))
    meet = "exists(flatten(slice(kept, greatest(1, cell - 1), 3)), o -> h.i < o.i - o.first AND o.i < h.i - h.first AND h.j < o.j - o.first AND o.j < h.j - h.first)"
    put = "concat(slice(kept, 1, cell - 1), array(array_append(kept[cell - 1], h)), slice(kept, cell + 1, size(kept)))"
    cell = "cast((h.j - low) div size AS int) + 1"
    step = f"if({meet}, kept, {put})".replace("cell", f"({cell})")
    kept = f"flatten(aggregate(h, array_repeat(slice(h, 1, 0), cast((high - low) div size AS int) + 1), (kept, h) -> {step}))"
    chosen = each.select("key", "rc", F.explode(F.expr(f"if(size(h) = 1, h, {kept})")).alias("h"))
    return chosen.withColumn("h", F.expr("named_struct('n', -h.first, 'wrong', h.wrong, 'i', h.i, 'j', h.j, 'bad', h.bad, 'x', h.x, 'y', coalesce(h.y, h.x))"))


def guide_hits(pairs: DataFrame, k: int = 9, allowed: int = 1, exact: int = 9, inexact: int = 12) -> DataFrame:
    """Hits of each key: seeds, growth, the length rule of `tiered`, and a greedy choice of hits of an orientation that do not overlap on both sides.

    Longer hits come first, then those with fewer mismatches, then the order of seeds. key may be of any type that can be grouped, also a
    struct. Nulls and sequences below k letters give no hits. Seeds that grow to one hit are met as one, so the choice walks
    over the different hits of a key and orientation, an island of the stretch at a time.
    """
    seeds = _seeds(pairs, k, True).withColumn("stays", F.expr(_stays(k, allowed)))
    grown = _held(seeds, h=F.expr(f"if(stays, struct(i AS i, j AS j, {k} AS n, cast(array() AS array<int>) AS bad), if(rc, {_grown_reverse(k, allowed)}, {_grown_forward(k, allowed)}))"))
    hits = grown.select("key", "a", "b", "base", "rc", "h.*", F.col("i").alias("i0"), F.col("j").alias("j0")).where(tiered(F.col("n"), F.size("bad"), allowed, exact, inexact))
    hits = hits.select("key", "rc", "i", (F.col("base") + F.col("j")).alias("j"), "n", "bad", "i0", (F.col("base") + F.col("j0")).alias("j0"), F.expr("substr(a, i + 1, n)").alias("x"), F.expr("substr(b, j + 1, n)").alias("y"))
    hits = hits.groupBy("key", "rc", "i", "j", "n").agg(F.min(F.struct("i0", "j0")).alias("seed"), F.first("bad").alias("bad"), F.first("x").alias("x"), F.first("y").alias("y"))
    chosen = _chosen(_islands(hits))
    long = lambda c: F.col(f"h.{c}").cast("long")
    return chosen.select(
        "key", long("i").alias("pos_in_flanking"), long("j").alias("pos_in_noncoding"), long("n").alias("length"), F.when(F.col("rc"), REVERSE).otherwise(FORWARD).alias("orientation"),
        F.col("h.wrong").alias("mismatches"), F.col("h.bad").alias("mismatch_positions"), F.col("h.x").alias("seq_flanking"), F.col("h.y").alias("seq_noncoding"),
    )


def region_pairs(records: DataFrame) -> DataFrame:
    """key (is_id, flanking_source, noncoding_region_index, ...), flank_seq, nc_seq: each noncoding region of an element with each of its flanks.

    records follows schemas.RECORD; regions are 1-based and inclusive, their index counts from 0. Empty flanks and regions are left out.
    """
    flanks = F.array(*[F.struct(F.lit(s).alias("source"), F.col(f"flanking_{s}.sequence").alias("seq")) for s in ("upstream", "downstream")])
    rows = records.select("is_id", F.col("is_element.sequence").alias("seq"), flanks.alias("flanks"), F.posexplode("orf_annotation.noncoding_regions").alias("index", "r"))
    rows = rows.select("is_id", "index", "r", F.expr("substring(seq, cast(greatest(r.start, 1) AS int), cast(r.`end` - greatest(r.start, 1) + 1 AS int))").alias("nc_seq"), F.explode("flanks").alias("f"))
    key = F.struct("is_id", F.col("f.source").alias("flanking_source"), F.col("index").alias("noncoding_region_index"), F.col("r.type").alias("noncoding_region_type"), F.col("r.start").alias("noncoding_start"), F.col("r.end").alias("noncoding_end"))
    return rows.where("f.seq <> '' AND nc_seq <> ''").select(key.alias("key"), F.col("f.seq").alias("flank_seq"), "nc_seq")


def record_guides(records: DataFrame, **how) -> DataFrame:
    """is_id, and the columns of a record's guide_hits, of each hit between a noncoding region and a flank of its element."""
    return guide_hits(region_pairs(records), **how).select("key.*", *[c for c in ("pos_in_flanking", "pos_in_noncoding", "length", "orientation", "mismatches", "mismatch_positions", "seq_flanking", "seq_noncoding")])


def with_guides(records: DataFrame, **how) -> DataFrame:
    """records with their guide_hits (by region, flank and place) and guide_summary; empty and zero for elements without hits."""
    found = record_guides(records, **how)
    fields = [c for c in found.columns if c != "is_id"]
    turn = F.struct("noncoding_region_index", (F.col("flanking_source") != "upstream").alias("turn"), "pos_in_flanking", "pos_in_noncoding", "orientation", F.struct(*fields).alias("hit"))
    lists = found.groupBy("is_id").agg(F.transform(F.array_sort(F.collect_list(turn)), lambda x: x.hit).alias("guide_hits"))
    summary = guide_summary(found.withColumn("key", F.col("is_id")), records.select(F.col("is_id").alias("key")))
    summary = summary.select(F.col("key").alias("is_id"), F.struct(F.col("n_hits").cast("long").alias("n_hits"), "best_length", "has_revcomp_hit").alias("guide_summary"))
    out = records.drop("guide_hits", "guide_summary").join(lists, "is_id", "left").join(summary, "is_id", "left")
    kind = dict(lists.dtypes)["guide_hits"]
    return out.withColumn("guide_hits", F.coalesce("guide_hits", F.array().cast(kind)))


def guide_summary(hits: DataFrame, keys: DataFrame) -> DataFrame:
    """n_hits, best_length, has_revcomp_hit for every key; zero and false without hits."""
    s = hits.groupBy("key").agg(F.count(F.lit(1)).alias("n_hits"), F.max("length").alias("best_length"), F.bool_or(F.col("orientation") == "reverse_complement").alias("has_revcomp_hit"))
    return keys.select("key").distinct().join(s, "key", "left").select("key", F.coalesce("n_hits", F.lit(0)).alias("n_hits"), F.coalesce("best_length", F.lit(0)).alias("best_length"), F.coalesce("has_revcomp_hit", F.lit(False)).alias("has_revcomp_hit"))


def best_guide(hits: DataFrame) -> DataFrame:
    """The first longest hit's flank sequence for each key."""
    return hits.groupBy("key").agg(F.max_by("seq_flanking", F.struct("length", -F.col("pos_in_flanking"), -F.col("pos_in_noncoding"))).alias("best_guide"))
