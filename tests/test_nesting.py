"""Insertions of a host and core: one pass over their blocks."""

from lociq.operators import nesting


def test_events_shuffle_blocks_once(spark):
    row = lambda core, cs, hs, k: ("h", core, 500, 300, cs, cs + 100, hs, hs + 100, 95, 100, k)
    rows = [row("a", 0, 0, 1), row("a", 100, 250, 2), row("b", 0, 300, 3), row("b", 150, 100, 4), row("c", 0, 0, 5), (None, *row("d", 0, 0, 6)[1:]), (None, *row("d", 100, 300, 7)[1:])]
    blocks = spark.createDataFrame(rows, "host string, core string, host_len long, core_len long, core_start long, core_end long, host_start long, host_end long, matches long, aligned long, ordinal long")
    seqs = spark.createDataFrame([("h", "A" * 100 + "C" * 150 + "G" * 250)], "id string, seq string")
    found = nesting.nesting_events(blocks, seqs)
    (r,) = found.collect()  # b turns back, c has one block, d's host is unknown
    assert (r.host, r.core, r.n_aligned_blocks, r.n_insertions, r.total_insertion_bp) == ("h", "a", 2, 1, 150)
    assert tuple(r.insertions[0]) == (100, 250, 100, 150, "C" * 150)
    assert nesting.nesting_events(blocks)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 1
