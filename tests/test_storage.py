"""Intermediate tables go when nothing reads them any more."""

import os

from lociq.storage import Rounds, scratch, shared_dir, stored


def names(spark):
    return {n.rsplit("-", 1)[0] for n in os.listdir(shared_dir(spark).removeprefix("file://") + "/lociq") if n.startswith("storage-test")}


def test_scratch_keeps_what_is_named(spark):
    with scratch(spark, "storage-test-kept"):
        a = stored(spark.range(5), "storage-test-a")
        with scratch(spark, "storage-test-inner"):
            b = stored(a.selectExpr("id + 1 AS id"), "storage-test-inner")
            stored(b, "storage-test-gone")
        assert names(spark) == {"storage-test-a", "storage-test-inner"}
        kept = stored(b, "storage-test-kept")
    assert names(spark) == {"storage-test-kept"} and kept.count() == 5


def test_rounds_hold_one_table_of_a_name(spark):
    rounds = Rounds(spark)
    df = spark.range(3)
    for _ in range(3):
        df = rounds.next(df.selectExpr("id * 2 AS id"), "storage-test-round")
    assert sorted(r.id for r in df.collect()) == [0, 8, 16]
    assert [n for n in os.listdir(shared_dir(spark).removeprefix("file://") + "/lociq") if n.startswith("storage-test-round")].__len__() == 1
    rounds.drop("storage-test-round")
    assert "storage-test-round" not in names(spark)
