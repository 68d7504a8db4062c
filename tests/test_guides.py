"""The guide search against a letter-by-letter one, on random, repetitive and empty pairs, and over an element's regions and flanks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociq.operators import guides
from lociq.schemas import RECORD

PAIR = str.maketrans("ACGTacgt", "TGCAtgca")


def brute(a, b, k=9, allowed=1, exact=9, inexact=12):
    a, b = (a or "").upper(), (b or "").upper()
    hits = []
    for i in range(len(a) - k + 1):
        for rc in (False, True):
            side = lambda s: s.translate(PAIR)[::-1] if rc else s  # noqa: B023, E731
            wrong = lambda i, j, n: [p for p in range(n) if a[i : i + n][p] != side(b[j : j + n])[p]]  # noqa: B023, E731
            for j in range(len(b) - k + 1):
                if a[i : i + k] != side(b[j : j + k]):
                    continue
                x, y, n = i, j, k
                while x + n < len(a) and y + n < len(b) and len(wrong(x, y, n + 1)) <= allowed:
                    n += 1
                while x and y and len(wrong(x - 1, y - 1, n + 1)) <= allowed:
                    x, y, n = x - 1, y - 1, n + 1
                bad = wrong(x, y, n)
                if (not bad and n >= exact) or (len(bad) <= allowed and n >= inexact):
                    hits.append((x, y, n, rc, bad))
    kept = []
    for h in sorted(hits, key=lambda h: (-h[2], len(h[4]))):
        if not any(h[3] == o[3] and h[0] < o[0] + o[2] and o[0] < h[0] + h[2] and h[1] < o[1] + o[2] and o[1] < h[1] + h[2] for o in kept):
            kept.append(h)
    return {(x, y, n, "reverse_complement" if rc else "forward", len(bad), tuple(bad), a[x : x + n], b[y : y + n]) for x, y, n, rc, bad in kept}


def pairs_of(kind, rng):
    dna = lambda n, letters="ACGT": "".join(rng.choice(list(letters), n))
    if kind == "random":
        for _ in range(25):
            a, b = dna(int(rng.integers(5, 50))), dna(int(rng.integers(5, 90)))
            at = int(rng.integers(0, len(a)))
            part = a[at : at + 18]
            yield a, b[:30] + part + b[30:] + dna(int(rng.integers(0, 3))) + part.translate(PAIR)[::-1]
    elif kind == "repetitive":
        for _ in range(8):
            yield dna(int(rng.integers(9, 40)), "AC"), dna(int(rng.integers(9, 60)), "AC")
        yield from [("A" * 30, "A" * 40), ("AT" * 15, "AT" * 20), ("ACG" * 8, "CGT" * 9)]
    else:
        yield from [("", "ACGTACGTACGT"), (None, "ACGTACGTACGT"), ("ACGTACGTACGT", None), ("ACGTACGT", "ACGTACGT"), ("ACGTACGTA", "ACGTACGTA"), ("acgtnACGTNacgt", "ACGTNACGTNACGT"), ("éACGTACGTAG", "CéACGTACGTAGé")]


@pytest.mark.parametrize("allowed", [0, 1, 2])
@pytest.mark.parametrize("kind", ["random", "repetitive", "odd"])
def test_hits_are_those_of_a_letter_by_letter_search(spark, kind, allowed, monkeypatch):
    monkeypatch.setattr(guides, "PIECE", 8)
    monkeypatch.setattr(guides, "PIECES", 2)
    rows = [(k, a, b) for k, (a, b) in enumerate(pairs_of(kind, np.random.default_rng(allowed)))]
    df = spark.createDataFrame(rows, "key int, flank_seq string, nc_seq string")
    got = {k: set() for k, _, _ in rows}
    for r in guides.guide_hits(df, allowed=allowed).collect():
        got[r.key].add((*r[1:6], tuple(r.mismatch_positions), r.seq_flanking, r.seq_noncoding))
    assert got == {k: brute(a, b, allowed=allowed) for k, a, b in rows}


def test_no_python_worker_takes_part(spark):
    df = spark.createDataFrame([(1, "ACGT", "ACGT")], "key int, flank_seq string, nc_seq string")
    plan = guides.guide_hits(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_a_long_stretch_of_one_letter(spark):
    """Every place is a seed; runs stand for their seeds, so hits grow with the stretch and not with its square."""
    df = spark.createDataFrame([(1, "A" * 40, "A" * 20_000)], "key int, flank_seq string, nc_seq string")
    hits = guides.guide_hits(df).collect()
    assert sum(r.length == 40 for r in hits) == 500 and len(hits) < 520


def test_regions_and_flanks_of_records(spark):
    x, rc = "ACGATTGCATCC", "GGATGCAATCGT"
    seq = "T" * 20 + x + "G" * 20 + rc + "T" * 20
    record = lambda i, up, down, regions: {"is_id": i, "is_element": {"sequence": seq}, "flanking_upstream": {"sequence": up}, "flanking_downstream": {"sequence": down}, "orf_annotation": {"noncoding_regions": regions}}
    both = [{"start": 1, "end": 40, "type": "upstream"}, {"start": 45, "end": len(seq), "type": "intergenic"}]
    rows = [record("a", f"C{x}C", f"A{x}A", both), record("b", "", f"A{x}A", both), record("c", f"C{x}C", "", []), record("d", f"C{x}C", "", None), record("e", "ACAC", None, both)]
    records = spark.createDataFrame(rows, RECORD)
    got = {(r.is_id, r.flanking_source, r.noncoding_region_index, r.noncoding_region_type, r.orientation) for r in guides.record_guides(records).collect()}
    assert got == {("a", s, *w) for s in ("upstream", "downstream") for w in [(0, "upstream", "forward"), (1, "intergenic", "reverse_complement")]} | {("b", "downstream", 0, "upstream", "forward"), ("b", "downstream", 1, "intergenic", "reverse_complement")}
    whole = {r.is_id: r for r in guides.with_guides(records).collect()}
    assert set(whole) == set("abcde") and len(whole["a"].guide_hits) == 4 and whole["c"].guide_hits == [] and tuple(whole["c"].guide_summary) == (0, 0, False)
    assert [h.flanking_source for h in whole["a"].guide_hits] == ["upstream", "downstream"] * 2 and whole["a"].guide_summary.has_revcomp_hit
    assert all(seq[h.noncoding_start - 1 :].upper().startswith(seq[h.noncoding_start - 1 : h.noncoding_end][: h.pos_in_noncoding] + h.seq_noncoding) for h in whole["a"].guide_hits)


def test_best_guide(spark):
    hits = spark.createDataFrame([(1, 3, 0, 9, "A"), (1, 5, 2, 12, "C"), (1, 5, 1, 12, "G"), (2, 0, 0, 9, "T")], "key int, pos_in_flanking int, pos_in_noncoding int, length int, seq_flanking string")
    assert {r.key: r.best_guide for r in guides.best_guide(hits).select("key", F.col("best_guide")).collect()} == {1: "G", 2: "T"}


def test_signs_of_expressions_in_sequences_are_letters(spark):
    rows = [(1, "AC.T\\E*GT(C", "GGAC.T\\E*GT(CGG"), (2, "AC.TAC*GT", "ACGTACCGT"), (3, "A\nC[GT]AC^", "TTA\nC[GT]AC^$")]
    df = spark.createDataFrame(rows, "key int, flank_seq string, nc_seq string")
    got = {k: set() for k, _, _ in rows}
    for r in guides.guide_hits(df).collect():
        got[r.key].add((*r[1:6], tuple(r.mismatch_positions), r.seq_flanking, r.seq_noncoding))
    assert got == {k: brute(a, b) for k, a, b in rows}


def test_the_choice_looks_at_near_hits_only(spark):
    """A stretch of short repeats has tens of thousands of hits for one flank: each meets those kept beside it, not all that are kept."""
    df = spark.createDataFrame([(1, "ACGT" * 20, "ACGT" * 1_000)], "key int, flank_seq string, nc_seq string")
    hits = guides.guide_hits(df)
    far = spark.createDataFrame([(1, False, 0, 100 * k, 9, (0, 100 * k), [], "", "") for k in range(50)], "key int, rc boolean, i int, j int, n int, seed struct<i0:int,j0:int>, bad array<int>, x string, y string")
    assert guides._islands(far).select("island").distinct().count() == 50 and guides._chosen(guides._islands(far)).count() == 50
    kept = [(r.orientation, r.pos_in_flanking, r.pos_in_noncoding, r.length) for r in hits.collect()]
    assert sum(n == 80 and o == "forward" for o, _, _, n in kept) == 50
    for o, i, j, n in kept[::37]:
        assert not any(o == p and (i, j) != (x, y) and i < x + m and x < i + n and j < y + m and y < j + n for p, x, y, m in kept)
