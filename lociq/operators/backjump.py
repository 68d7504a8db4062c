"""Back-jumps of split reads, and partial circles from them."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociq.storage import stored


def back_jumps(segments: DataFrame, length: int, min_size: int = 100, max_fraction: float = 0.9, min_overlap: int = 50) -> DataFrame:
    """Neighbouring segments of a read, by query order on one element and strand, of which the second begins before the first ends."""
    w = Window.partitionBy("read_id", "ref_id", "is_reverse").orderBy("query_start", "seg")
    step = segments.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in ("ref_start", "ref_end", "mapq")])
    out = step.select(
        "read_id", "ref_id", F.col("next_ref_start").alias("circle_start"), F.col("ref_end").alias("circle_end"), (F.col("ref_end") - F.col("next_ref_start")).alias("circle_size"),
        (F.col("ref_end") - F.col("ref_start")).alias("overlap_before"), (F.col("next_ref_end") - F.col("next_ref_start")).alias("overlap_after"), F.least("mapq", "next_mapq").alias("mapping_quality"), "seg",
    )
    return out.where((F.col("circle_size") > 0) & (F.col("circle_size") >= min_size) & (F.col("circle_size") / length <= max_fraction) & (F.col("overlap_before") >= min_overlap) & (F.col("overlap_after") >= min_overlap))


class GreedyClusters:
    """Cluster numbers of points that come by x: a point joins the oldest cluster with a member within tolerance on both axes.

    A point that is near to two clusters joins the older one and does not merge them. Members further back on x than the tolerance are
    forgotten, and of members on one y only those that are older than all later ones are kept, so a point costs 2 * tolerance + 1 looks.
    """

    def __init__(self, tolerance: int) -> None:
        self.tolerance, self.n, self.clear = tolerance, 0, None
        self.rows: dict[int, deque[tuple[int, int]]] = {}  # y: (x, cluster) with rising x and cluster

    def place(self, x: int, y: int) -> int:
        since = x - self.tolerance
        if self.clear is None or since > self.clear:  # all that is further back, once in a tolerance
            self.clear = x
            for old in [z for z, row in self.rows.items() if row[-1][0] < since]:
                del self.rows[old]
        k = self.n
        for z in range(y - self.tolerance, y + self.tolerance + 1):
            row = self.rows.get(z)
            if row:
                while row and row[0][0] < since:
                    row.popleft()
                if row:
                    k = min(k, row[0][1])
                else:
                    del self.rows[z]
        self.n += k == self.n
        row = self.rows.setdefault(y, deque())
        while row and row[-1][1] >= k:
            row.pop()
        row.append((x, k))
        return k


def islands(jumps: DataFrame, tolerance: int = 20) -> DataFrame:
    """jumps with an island number within ref_id: circle starts of different islands lie further apart than the tolerance, so no cluster crosses them."""
    w = Window.partitionBy("ref_id").orderBy("circle_start")
    first = F.coalesce(F.col("circle_start") - F.lag("circle_start").over(w) > tolerance, F.lit(True)).cast("int")
    up_to = w.rowsBetween(Window.unboundedPreceding, 0)
    return jumps.withColumn("new_", first).withColumn("island", F.sum("new_").over(up_to)).drop("new_")


def places(jumps: DataFrame) -> DataFrame:
    """ref_id, circle_start, circle_end of jumps, each once."""
    return jumps.select("ref_id", "circle_start", "circle_end").distinct()


def cluster_breakpoints(jumps: DataFrame, tolerance: int = 20) -> DataFrame:
    """jumps with an island within ref_id and a cluster within the island.

    Jumps of one place come one after another and go to one cluster, so the fold, which is sequential in an island and streams its sorted
    rows, has each place once: its length depends on the coordinates, not on the reads.
    """

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, state = None, GreedyClusters(tolerance)
        for pdf in frames:
            found = []
            for ref, island, x, y in pdf[["ref_id", "island", "circle_start", "circle_end"]].itertuples(index=False):
                if group != (ref, island):
                    group, state = (ref, island), GreedyClusters(tolerance)
                found.append(state.place(x, y))
            yield pdf.assign(cluster=pd.Series(found, index=pdf.index, dtype="int32"))

    at = ["ref_id", "circle_start", "circle_end"]
    jumps = stored(jumps, "jumps")  # read twice, and far smaller than the segments
    rows = islands(places(jumps), tolerance)
    parts = int(jumps.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, but a long fold for each of them
    dealt = rows.repartition(parts, "ref_id", "island").sortWithinPartitions("ref_id", "island", "circle_start", "circle_end")
    found = dealt.mapInPandas(fold, schema=f"{', '.join(f'{n} {t}' for n, t in rows.dtypes)}, cluster int")
    jumps, found = jumps.alias("j"), found.alias("f")
    same = reduce(and_, [F.col(f"j.{c}").eqNullSafe(F.col(f"f.{c}")) for c in at])
    return jumps.join(found, same).select("j.*", "f.island", "f.cluster")


def partial_circles(jumps: DataFrame, length: int, tolerance: int = 20, min_reads: int = 2, min_size: int = 100, max_fraction: float = 0.9) -> DataFrame:
    """Calls with median coordinates (cut to whole numbers) of clusters with enough reads."""
    grouped = cluster_breakpoints(jumps, tolerance).groupBy("ref_id", "island", "cluster")
    calls = grouped.agg(
        F.floor(F.median("circle_start")).alias("circle_start"), F.floor(F.median("circle_end")).alias("circle_end"), F.count(F.lit(1)).alias("n_supporting_reads"),
        F.round(F.avg("mapping_quality"), 1).alias("mean_mapq"), F.array_sort(F.collect_list("read_id")).alias("supporting_read_names"),
    )
    calls = calls.withColumn("circle_size", F.col("circle_end") - F.col("circle_start")).withColumn("circle_fraction", F.round(F.col("circle_size") / length, 4))
    return calls.where((F.col("n_supporting_reads") >= min_reads) & (F.col("circle_size") >= min_size) & (F.col("circle_size") / length <= max_fraction)).drop("island", "cluster")
