"""Queries of the catalog: findings of round 4."""

from __future__ import annotations

from pathlib import Path

from lociq.plans import QUERIES, catalog, records
from lociq.storage import new_path, stored


def test_checked_records_writes_a_file_for_each_supplier_in_few_folders(spark, tmp_path, monkeypatch):
    keys = spark.range(1, 1_001).withColumnRenamed("id", "s_suppkey")
    keys.coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    paths = []
    monkeypatch.setattr(records, "new_path", lambda s, name: paths.append(new_path(s, name)) or paths[-1])
    got = {r.reason: r.n for r in QUERIES["checked_records"](spark, str(tmp_path)).collect()}
    assert got == {"kept": 778, "no is_id": 111, "not JSON": 111}
    files = list(Path(paths[0].removeprefix("file://")).glob("folder=*/*.txt"))
    assert len(files) == 1_000 and len({f.parent for f in files}) == 11
    assert len({f.name.split("-")[1] for f in files}) > 1  # tasks


def test_variants_read_whole_texts_once(spark, monkeypatch):
    """Only the table of members reads documents; its rows and the variants' plan stay short."""
    made = []
    monkeypatch.setattr(catalog, "stored", lambda df, name: made.append(name) or stored(df, name))
    for name in ("l1_variants", "l2_variants"):
        made.clear()
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert made == ["members"] and "regexp_replace" not in plan
