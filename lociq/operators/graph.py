"""Families, connected components, communities, variants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociq.operators.ranking import global_row_number
from lociq.operators.similarity import joined_strings
from lociq.storage import stored


def incidence(members: DataFrame) -> DataFrame:
    """Distinct (is_id, family)."""
    return members.select("is_id", "family").where("is_id IS NOT NULL AND family IS NOT NULL").distinct()


#: Edges that a task of a round writes at least, where there are so many.
EDGES_IN_FILE = 100_000


def components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """node, component (the smallest node reached). nodes (a column `node`) adds nodes without edges.

    Alternating stars: every node hooks its larger neighbours to its smallest one, until nothing changes. Each round is written
    to the shared folder; the driver sees a count and a checksum.
    """
    norm = lambda df: df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = stored(norm(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), "edges")
    before = None
    while (sign := tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())) != before and sign[0]:
        before = sign
        few = lambda df: df.coalesce(max(1, -(-sign[0] // EDGES_IN_FILE)))  # noqa: B023, E731  no more files than the edges fill
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = stored(few(norm(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        now = stored(few(norm(large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))))), "edges")
    found = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    found = found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
    if nodes is None:
        return found
    return nodes.select("node").distinct().join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


#: Steps of modularity smaller than this count as none; sums of floating-point numbers differ by less.
LEAST_GAIN = 1e-9
#: Similarities are summed as whole numbers of this size, so that sums do not depend on their order.
WHOLE = 1 << 30


def _votes(links: DataFrame, label: DataFrame, total: int, resolution: float) -> tuple[DataFrame, float]:
    """(node, own, d, c, k: the weight between a node and each community near it; the modularity of label but for loops)."""
    near = links.join(label.select(F.col("node").alias("v"), "c"), "v").groupBy("node", "c").agg(F.sum("w").alias("k"))
    votes = stored(near.join(label.select("node", F.col("c").alias("own"), "d"), "node"), "votes")
    inside = votes.where("c = own").agg(F.coalesce(F.sum("k"), F.lit(0))).first()[0]
    spread = label.groupBy("c").agg(F.sum("d").alias("d")).agg(F.sum((F.col("d") / total) ** 2)).first()[0]
    return votes, inside / total - resolution * spread


def _gains(votes: DataFrame, label: DataFrame, total: int, resolution: float) -> DataFrame:
    """node, own, c, gain of modularity by moving the node to c, for each community near it but its own."""
    size = label.groupBy("c").agg(F.sum("d").alias("size"))
    kept = votes.where("c = own").select("node", F.col("k").alias("kept"))
    other = votes.where("c <> own").join(size, "c").join(size.select(F.col("c").alias("own"), F.col("size").alias("left")), "own").join(kept, "node", "left")
    gain = F.col("k") - F.coalesce("kept", F.lit(0)) - resolution * F.col("d") * ((F.col("size") - F.col("left") + F.col("d")) / total)
    return other.select("node", "own", "c", (2 * gain / total).alias("gain"))


def _proposals(votes: DataFrame, label: DataFrame, total: int, resolution: float) -> DataFrame:
    """node, own, c, loss (the gain with its sign turned) of each node that a move to c raises modularity for: its best one."""
    best = _gains(votes, label, total, resolution).where(F.col("gain") > LEAST_GAIN).select("node", "own", F.struct((-F.col("gain")).alias("loss"), "c").alias("move"))
    return best.groupBy("node", "own").agg(F.min("move").alias("move")).select("node", "own", "move.c", "move.loss")


def _settled(links: DataFrame, label: DataFrame, total: int, resolution: float, seed: int) -> tuple[DataFrame, bool]:
    """label (node, d, c) after rounds of moves until no node has one, and whether any was made.

    In a round each node names the move that raises modularity most. Communities have a random order, and moves up in it are made together;
    if modularity does not rise by them, only moves are made that are the best for both of their communities (gains of moves
    between disjoint communities add up, so it rises).
    """
    votes, score = _votes(links, label, total, resolution)
    turn = 0
    while True:
        moves = stored(_proposals(votes, label, total, resolution), "moves")
        if not moves.limit(1).count():
            return label, turn > 0
        rank = lambda c: F.xxhash64(c, F.lit(seed + turn))  # noqa: B023, E731
        ends = moves.select("node", "loss", F.explode(F.array("own", "c")).alias("at")).groupBy("at").agg(F.min(F.struct("loss", "node")).node.alias("node"))
        alone = ends.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n = 2").select("node")
        for some in (moves.where(rank("own") < rank("c")), moves.join(alone, "node", "left_semi")):
            tried = label.join(some.select("node", F.col("c").alias("to")), "node", "left").select("node", "d", F.coalesce("to", "c").alias("c"))
            tried = stored(tried, "labels")
            found, now = _votes(links, tried, total, resolution)
            if now > score:
                break
        else:
            return label, turn > 0
        label, votes, score, turn = tried, found, now, turn + 1


def _links(edges: DataFrame) -> DataFrame:
    both = edges.where("a <> b").select(F.col("a").alias("node"), F.col("b").alias("v"), "similarity")
    both = both.unionByName(both.select(F.col("v").alias("node"), F.col("node").alias("v"), "similarity"))
    return both.groupBy("node", "v").agg(F.sum(F.round(F.col("similarity") * WHOLE).cast("long")).alias("w"))


def _connected(links: DataFrame, label: DataFrame) -> DataFrame:
    """node, part: the smallest node that it reaches within its community (label: node, c)."""
    inside = links.join(label.select("node", "c"), "node").join(label.select(F.col("node").alias("v"), F.col("c").alias("other")), "v").where("c = other AND node < v")
    return components(inside.select(F.col("node").alias("a"), F.col("v").alias("b")), label).select("node", F.col("component").alias("part"))


def communities(edges: DataFrame, nodes: DataFrame, resolution: float = 1.0, seed: int = 42) -> DataFrame:
    """node, community (its smallest member): Louvain's moves and levels over the whole graph, then a refinement, in DataFrame rounds at any size.

    A level ends when no node has a move (see _settled); its communities are the nodes of the next one. Levels can leave a community that
    falls apart without a node that has gone, and nodes that would gain by a move of their own. So communities are then cut into their connected
    parts, which never lowers modularity, and nodes move again, until no community falls apart and no move of one node to another community gains
    more than LEAST_GAIN; community_certificate shows both.
    """
    base = stored(_links(edges), "links")
    degrees = stored(base.groupBy("node").agg(F.sum("w").alias("d")), "labels")
    total = degrees.agg(F.sum("d")).first()[0]
    if not total:
        return nodes.select("node").distinct().withColumn("community", F.col("node"))
    links, label, own, moved = base, degrees.withColumn("c", F.col("node")), degrees.select("node", F.col("node").alias("community")), True
    while moved:
        label, moved = _settled(links, label, total, resolution, seed)
        if moved:
            own = stored(own.join(label.select(F.col("node").alias("community"), "c"), "community").select("node", F.col("c").alias("community")), "communities")
            names = label.select("node", "c")
            links = links.join(names, "node").join(names.select(F.col("node").alias("v"), F.col("c").alias("other")), "v").where("c <> other")
            links = stored(links.groupBy(F.col("c").alias("node"), F.col("other").alias("v")).agg(F.sum("w").alias("w")), "links")
            label = stored(label.groupBy("c").agg(F.sum("d").alias("d")).withColumn("node", F.col("c")), "labels")
    label, moved = degrees.join(own.withColumnRenamed("community", "c"), "node").select("node", "d", "c"), True
    while moved:
        label = stored(degrees.join(_connected(base, label), "node").select("node", "d", F.col("part").alias("c")), "labels")
        label, moved = _settled(base, label, total, resolution, seed)
    named = label.join(label.groupBy("c").agg(F.min("node").alias("least")), "c").select("node", "least")
    return nodes.select("node").distinct().join(named, "node", "left").select("node", F.coalesce("least", "node").alias("community"))


def community_certificate(edges: DataFrame, labels: DataFrame, resolution: float = 1.0) -> DataFrame:
    """community, size, parts (connected ones within it), best_gain (of modularity, by moving one of its nodes to another community near it; at least 0)."""
    links = stored(_links(edges), "links")
    c = stored(labels.select("node", F.col("community").alias("c")), "labels")
    label = stored(links.groupBy("node").agg(F.sum("w").alias("d")).join(c, "node").select("node", "d", "c"), "labels")
    out = c.join(_connected(links, c), "node").groupBy(F.col("c").alias("community")).agg(F.count(F.lit(1)).alias("size"), F.count_distinct("part").alias("parts"))
    total = label.agg(F.sum("d")).first()[0]
    if not total:
        return out.withColumn("best_gain", F.lit(0.0))
    votes, _ = _votes(links, label, total, resolution)
    best = _gains(votes, label, total, resolution).groupBy(F.col("own").alias("community")).agg(F.max("gain").alias("best_gain"))
    return out.join(best, "community", "left").withColumn("best_gain", F.greatest(F.coalesce("best_gain", F.lit(0.0)), F.lit(0.0)))


def flank_variants(members: DataFrame, limit: int = 10) -> DataFrame:
    """cluster, is_id, l1 (smallest member of its variant): single linkage at `limit` edits. is_id is unique over clusters."""
    found = components(joined_strings(members, limit), members.select(F.col("is_id").alias("node")))
    return members.select("cluster", "is_id").join(found.select(F.col("node").alias("is_id"), F.col("component").alias("l1")), "is_id")


def guide_variants(variants: DataFrame) -> DataFrame:
    """cluster, is_id, l1, l2: labels `l1.k`, where k counts the pairs of l1 and guide in order of their first member."""
    first = variants.groupBy("cluster", "l1", "guide").agg(F.min("is_id").alias("first"))
    k = F.row_number().over(Window.partitionBy("cluster").orderBy("l1", "first"))
    return variants.join(first.withColumn("k", k), ["cluster", "l1", "guide"]).select("cluster", "is_id", "l1", F.concat_ws(".", F.col("l1").cast("string"), F.col("k").cast("string")).alias("l2"))


def assemble_clusters(labels: DataFrame) -> DataFrame:
    """cluster_id (from 0, largest first, then smallest member), size, members of labelled nodes (node, community)."""
    c = labels.groupBy("community").agg(F.count(F.lit(1)).alias("size"), F.array_sort(F.collect_list("node")).alias("members"))
    ranked = global_row_number(c, [F.desc("size"), F.col("community")], "k")  # no task ranks all clusters
    return ranked.select((F.col("k") - 1).alias("cluster_id"), "size", "members")
