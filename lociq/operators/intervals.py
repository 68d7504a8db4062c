"""Joins of intervals with many regions, and their numbers and lengths by region without a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociq.storage import stored

#: Widths of bins are powers of two from 2**FINEST to 2**COARSEST letters, each eight times the one below; above, one bin holds all.
FINEST, STEP, COARSEST = 14, 3, 44
#: A cell with more intervals than this is dealt to several tasks.
HOT_CELL = 200_000


def _shifts() -> list[int]:
    return list(range(FINEST, COARSEST + 1, STEP))


def overlaps(intervals: DataFrame, regions: DataFrame, on: str, interval: tuple[str, str] = ("ref_start", "ref_end"), region: tuple[str, str] = ("region_start", "region_end"), hot: int | None = None) -> DataFrame:
    """All columns of each interval with those of each region of the same `on` that it overlaps; both half-open, column names distinct but for `on`.

    An interval lies in one bin: the smallest that holds it. A region looks into the bins of each width that it touches, so a pair meets once.
    Nothing is compared outside of common bins, and there exactly. Intervals that are empty or have nulls overlap nothing. The
    intervals of a cell (bin of a reference) above `hot` are dealt by hash to several tasks, and its regions are sent to all of them.
    """
    (a, z), (s, e), hot = interval, region, hot or HOT_CELL
    level = F.coalesce(*[F.when(F.shiftright(a, k) == F.shiftright(F.col(z) - 1, k), F.lit(k)) for k in _shifts()], F.lit(63))
    x = intervals.where(F.col(a) < F.col(z)).withColumn("level_", level).withColumn("bin_", F.expr(f"if(level_ = 63, 0L, shiftright(cast({a} AS bigint), level_))"))
    every = " , ".join(f"transform(sequence(shiftright(cast({s} AS bigint), {k}), shiftright(cast({e} - 1 AS bigint), {k})), b -> struct({k} AS level_, b AS bin_))" for k in _shifts())
    y = regions.where(F.col(s) < F.col(e)).withColumn("cell_", F.explode(F.expr(f"concat({every}, array(struct(63 AS level_, 0L AS bin_)))"))).select("*", "cell_.*").drop("cell_")
    keys = [on, "level_", "bin_"]
    crowded = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_")).where(F.col("n_") > hot).select(*keys, F.ceil(F.col("n_") / hot).cast("int").alias("parts_"))  # no more rows than intervals / hot
    own = F.expr(f"if(parts_ IS NULL, 0, cast(pmod(xxhash64({', '.join(f'`{c}`' for c in intervals.columns)}), parts_) AS int))")
    x = x.join(crowded, keys, "left").withColumn("deal_", own).drop("parts_")
    y = y.join(crowded, keys, "left").withColumn("deal_", F.explode(F.expr("sequence(0, coalesce(parts_, 1) - 1)"))).drop("parts_")
    return x.join(y, [*keys, "deal_"]).where((F.col(a) < F.col(e)) & (F.col(z) > F.col(s))).drop("level_", "bin_", "deal_")


def overlap_totals(intervals: DataFrame, regions: DataFrame, on: str, region_id: str, interval: tuple[str, str] = ("ref_start", "ref_end"), region: tuple[str, str] = ("region_start", "region_end")) -> DataFrame:
    """region_id, n, bases: how many intervals of its `on` overlap a region, and the sum of their common lengths; all half-open.

    What `overlaps` gives when grouped by region_id, but no pair is made, so the work grows with the rows and not with the pairs: a region is
    overlapped by the intervals that start before its end, less those that end at or before its start, and the letters that intervals cover left of
    a place follow from the numbers and sums of the starts and ends before it. The places of both tables are dealt by range; running sums within a range start
    from those of the ranges before. Regions without an interval, and empty ones or those with nulls, are left out, and such intervals count
    nowhere. Rows that share a region_id are added. Sums that leave 63 bits raise an error.
    """
    (a, z), (s, e) = interval, region
    point = lambda df, column, turn, start, end, sign, key, tie: df.select(F.col(on).alias("on_"), F.col(column).cast("long").alias("at_"), F.lit(turn).alias("turn_"), F.lit(start).cast("long").alias("start_"), F.lit(end).cast("long").alias("end_"), F.lit(sign).cast("long").alias("sign_"), key.alias("key_"), tie.alias("tie_"))
    x = intervals.where((F.col(a) < F.col(z)) & F.col(on).isNotNull())
    y = regions.where((F.col(s) < F.col(e)) & F.col(on).isNotNull())
    none, kind = F.lit(None).cast(dict(regions.dtypes)[region_id]), F.xxhash64(region_id, s, e)
    # at one place first ends, then regions, then starts; ties only spread equal places over the ranges
    points = point(x, z, 0, 0, 1, 0, none, F.xxhash64(a)).union(point(y, s, 1, 0, 0, -1, F.col(region_id), kind)).union(point(y, e, 1, 0, 0, 1, F.col(region_id), kind)).union(point(x, a, 2, 1, 0, 0, none, F.xxhash64(z)))
    order = ["at_", "turn_", "tie_"]
    dealt = stored(points.repartitionByRange("on_", *order).withColumn("part_", F.spark_partition_id()), "overlap-points")
    each = {"starts_": "start_", "ends_": "end_", "from_": "start_ * at_", "to_": "end_ * at_"}
    sums = dealt.groupBy("on_", "part_").agg(*[F.sum(F.expr(what)).alias(f"{n}0") for n, what in each.items()])
    earlier = Window.partitionBy("on_").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)  # no more rows than ranges
    sums = stored(sums.select("on_", "part_", *[F.coalesce(F.sum(f"{n}0").over(earlier), F.lit(0)).alias(f"{n}0") for n in each]), "overlap-sums")
    running = Window.partitionBy("on_", "part_").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.select("*", *[F.sum(F.expr(what)).over(running).alias(n) for n, what in each.items()]).where("sign_ <> 0")
    placed = placed.join(sums, ["on_", "part_"]).selectExpr("key_", "sign_", "at_", *[f"{n} + {n}0 AS {n}" for n in each])
    covered = "(starts_ * at_ - from_) - (ends_ * at_ - to_)"
    totals = placed.groupBy("key_").agg(F.sum(F.expr("if(sign_ > 0, starts_, -ends_)")).alias("n"), F.sum(F.expr(f"sign_ * ({covered})")).alias("bases"))
    return totals.where("n > 0").select(F.col("key_").alias(region_id), "n", "bases")
