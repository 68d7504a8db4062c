"""Links within posting lists."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociq.operators.graph import components
from lociq.storage import stored

#: Ratio of neighbouring size bands.
BAND = 1.05
#: Rows of a band that meet in one task's key; a list's band is cut into parts of about this size.
PART_ROWS = 1024
#: The exhaustive step starts when it compares at most this many rows for each row of the lists.
LINEAR = 8
#: Lists in which a class looks for partners in one of the rounds before it; similar classes share many.
LISTS = 4


def _as_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _fit() -> Column:
    """Whether each row's size lies in the other's range."""
    return F.col("n").between(F.col("lo_"), F.col("hi_")) & F.col("n_").between(F.col("lo"), F.col("hi"))


def _band(size: Column) -> Column:
    return F.floor(F.log(size) / math.log(BAND)).cast("int")


def _side_by_side(posts: DataFrame) -> DataFrame:
    """token, salt, cls, n, lo, hi, before (the class before it in its part by size, if it fits), longer (whether its part has more than two rows, or its list has parts)."""
    w = Window.partitionBy("token", "salt").orderBy("n", "cls")
    fields = ("cls", "n", "lo", "hi")
    at = lambda f, k: f("n", k).over(w).isNotNull()
    longer = (F.col("salt") > 0) | at(F.lag, 2) | at(F.lead, 2) | (at(F.lag, 1) & at(F.lead, 1))
    near = posts.select("token", "salt", *fields, *[F.lag(c).over(w).alias(f"{c}_") for c in fields], longer.alias("longer"))
    return near.select("token", "salt", *fields, F.when(_fit(), F.col("cls_")).alias("before"), "longer")


def _neighbours(near: DataFrame) -> DataFrame:
    """Pairs of classes that follow each other in a list by size."""
    return _as_pairs(near.where("before IS NOT NULL"), "cls", "before")


def _undecided(posts: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the lists whose classes are not all in one component: with their labels, the list's commonest label `main`, and their band."""
    known = stored(posts.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls")), "known")
    sizes = known.groupBy("token", "label").agg(F.count(F.lit(1)).alias("k"))
    main = sizes.groupBy("token").agg(F.count(F.lit(1)).alias("labels"), F.max(F.struct("k", "label")).alias("m")).where("labels > 1")
    return known.join(main.select("token", F.col("m.label").alias("main")), "token").withColumn("band", _band(F.col("n")))


def _meetings(rest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bands, cells): the bands of each list with their rows k, and the bands that each class outside its list's main component may have
    partners in."""
    bands = stored(rest.groupBy("token", "band").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n0"), F.max("n").alias("n1"), F.min("lo").alias("lo0"), F.max("hi").alias("hi1")), "bands")
    apart = rest.where((F.col("label") != F.col("main")) & (F.col("hi") >= F.col("lo")))
    apart = apart.select("token", "cls", "n", "lo", "hi", "label", F.explode(F.sequence(_band(F.col("lo")), _band(F.col("hi")))).alias("band"))
    cells = apart.join(bands, ["token", "band"]).where("hi1 >= n AND lo0 <= n AND n0 <= hi AND n1 >= lo")
    return bands, stored(cells.select("token", "band", "k", *[F.col(c).alias(f"{c}_") for c in ("cls", "n", "lo", "hi", "label")]), "cells")


def _met(rest: DataFrame, bands: DataFrame, cells: DataFrame, partners: int | None, turn: int) -> DataFrame:
    """Pairs of different components: each cell's class with about `partners` rows of the cell's band, or with all of them."""
    parts = lambda size: F.ceil(F.col("k") / size).cast("int")
    size = partners or PART_ROWS
    rows = rest.join(bands.select("token", "band", "k"), ["token", "band"])
    rows = rows.withColumn("part", F.pmod(F.xxhash64("cls", F.lit(turn)), parts(size)).cast("int")).drop("k", "main")
    if partners:
        draw = F.row_number().over(Window.partitionBy("cls_").orderBy(F.xxhash64("token", "band", F.lit(turn)), "token", "band"))
        cells = cells.withColumn("draw", draw).where(F.col("draw") <= LISTS).drop("draw")
        part = F.pmod(F.xxhash64("cls_", "token", F.lit(turn)), parts(size)).cast("int")
    else:
        part = F.explode(F.sequence(F.lit(0), parts(size) - 1))
    met = rows.join(cells.withColumn("part", part).drop("k"), ["token", "band", "part"])
    return _as_pairs(met.where((F.col("label") != F.col("label_")) & _fit()), "cls", "cls_")


def link_lists(posts: DataFrame, verified: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """cls, label: classes that verified pairs of a common list connect have one label, the smallest of them; classes without a link are left out.

    posts has the rows of all lists: token (the list), salt (a part of a long list from 1, or 0 for a list that has no parts), cls, n (a
    size, from 1), lo and hi: two rows may be similar only if the size of each lies in the other's range. verified(pairs) keeps the true pairs.

    First, neighbours by size in each part and the parts' first rows are paired, which decides lists of two rows. In the rounds
    after it only classes outside their list's main component are paired, each in some of its lists, with classes of other components in
    bands of sizes that fit. A round makes about as many pairs as the lists have rows at most, so each outsider meets the more classes the fewer
    outsiders are left, and at least twice as many as in the round before. As soon as one such round is over and comparing every outsider with all
    rows that fit is no more than LINEAR times the lists' rows, or a round finds no link, that is done, and all is decided. No pair is
    verified twice.
    """
    near = stored(_side_by_side(posts), "neighbours")
    heads = near.where("salt > 0").groupBy("token", "salt").agg(F.min(F.struct("n", "cls", "lo", "hi")).alias("h")).select("token", F.lit(0).alias("salt"), "h.*")
    tried = stored(_neighbours(near).unionByName(_neighbours(_side_by_side(heads))).distinct(), "pairs")
    kind = dict(posts.dtypes)["cls"]
    labels = _joined(posts.sparkSession.createDataFrame([], f"cls {kind}, label {kind}"), stored(verified(tried), "links"))
    posts = near.where("longer").select("token", "cls", "n", "lo", "hi")
    partners, turn, done, stuck = 4, 0, False, False
    while not done:
        rest = stored(_undecided(posts, labels), "undecided")
        posts = rest.select("token", "cls", "n", "lo", "hi")  # a list that lies in one component stays in it
        bands, cells = _meetings(rest)
        rows = rest.count()
        outside, most, all_pairs = cells.agg(F.count(F.lit(1)), F.max("k"), F.sum("k")).first()
        if not outside:
            break
        turn += 1
        classes = cells.select("cls_").distinct().count()
        partners = max(2 * partners, rows // min(outside, LISTS * classes))
        done = (turn > 1 and all_pairs <= LINEAR * rows) or partners >= most or stuck
        met = _met(rest, bands, cells, None if done else partners, turn)
        new = stored(met.join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = tried.unionByName(new)
        links = stored(verified(new), "links")
        stuck = links.isEmpty()
        labels = _joined(labels, links)
    return labels


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels after new links: components of the labels that the links connect, not of all classes again."""
    at = lambda side: labels.select(F.col("cls").alias(side), F.col("label").alias(f"{side}_label"))
    between = links.join(at("a"), "a", "left").join(at("b"), "b", "left").select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b"))
    roots = components(between.where("a <> b").distinct())
    known = labels.unionByName(links.select(F.col("a").alias("cls")).union(links.select("b")).distinct().join(labels, "cls", "left_anti").select("cls", F.col("cls").alias("label")))
    moved = known.join(roots.select(F.col("node").alias("label"), "component"), "label", "left")
    return stored(moved.select("cls", F.coalesce("component", "label").alias("label")), "labels")
