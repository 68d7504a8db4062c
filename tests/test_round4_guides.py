"""Dealing of the guide search: findings of round 4."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lociq.operators import guides
from lociq.plans import catalog, fixtures

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")
def test_stretches_are_dealt_by_their_letters(spark, monkeypatch):
    """The tasks of the guide search grow with the table, not with the cores alone."""
    t = fixtures.Tables(spark, SF)
    cores = spark.sparkContext.defaultParallelism
    assert guides.parts_of(None, cores) == guides.parts_of(10, cores) == 4 * cores
    letters = 2 * t.documents.agg(F.sum(F.length("text"))).first()[0]
    monkeypatch.setattr(guides, "LETTERS", letters // 100)
    assert catalog._pairs(t).rdd.getNumPartitions() >= 100
