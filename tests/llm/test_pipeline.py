"""The pipeline against a brute-force version of its stages on a small fixture, and its stages' contract."""

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from test_llm_operators import brute_components, library

import corpus_pipeline
from lociq.llm import language_id, quality

WORD = public_tokenizers.path("word_bpe_49k.json")


def junk(k):
    """Rows 7, 17, ... copy the row three before, junk or not."""
    return (k - 3 if k % 10 == 7 else k) % 6 == 0 or k == 100


def corpus(spark, folder):
    rng = np.random.default_rng(9)
    words = [f"{a}{b}" for a in ("stone", "river", "cloud", "field") for b in ("", "s", "ing", "ed", "ly", "er")]
    rows = []
    for k in range(240):
        text = " ".join(rng.choice(words, 30))
        if k % 10 != 7 and junk(k):
            text = " ".join(f"{w}###" for w in rng.choice(words, 30))
        if k % 10 == 7:
            text = rows[k - 3][1] + " again"
        if k == 100:
            text = "12 34 56"
        rows.append((k, text, "en", f"s{k % 3}", len(text)))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, int(not junk(k)), 0) for k in range(120)], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{folder}/labels.parquet")
    return rows


def brute(spark, folder, rows):
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    good = {r.doc_id for r in quality.score_documents(docs, labels).collect() if r.accepted}
    left = [r for r in rows if r[0] in good]
    known = spark.createDataFrame(left, docs.schema)
    speaks = {r.doc_id for r in language_id.identify_languages(known).collect() if r.lang_pred != "und" and r.score >= 0.02}
    left = [r for r in left if r[0] in speaks]
    left = [r for r, (k, (_, root)) in zip(left, enumerate(brute_components([r[1] for r in left])), strict=True) if k == root]
    import hashlib

    sizes = defaultdict(int)
    for r in left:
        sizes[r[3]] += len(r[1].split())
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes))}
    total, target, free = sum(sizes.values()), {}, set(sizes)
    while free:  # share by weight; sources above three times their size are held there and the rest shared again
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        target |= {s: 3 * sizes[s] for s in over} if over else {s: level * weight[s] for s in free}
        free = free - over if over else set()
    copies = {}
    for s, size in sizes.items():
        at, quota = 0, int(target[s] + 0.5)
        for r in sorted((r for r in left if r[3] == s), key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest()):
            n = len(r[1].split())
            taken = sum(max(0, min(at + n + e * size, quota) - at - e * size) for e in range(3))
            copies[r[0]] = int(taken / n + 0.5)
            at += n
    return Counter({(r[0], len(library(WORD, r[1])[0])): copies[r[0]] for r in left if copies[r[0]]})


def test_pipeline(spark, tmp_path):
    rows = corpus(spark, str(tmp_path))
    got = Counter((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == brute(spark, str(tmp_path), rows)
    clean = {k for k, *_ in rows if not junk(k)}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for stage in (corpus_pipeline.quality, corpus_pipeline.language):
        docs = stage(spark, docs, str(tmp_path))
        assert clean <= {r.doc_id for r in docs.select("doc_id").collect()}


def test_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path):
    corpus(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "mixing", "encoding"]


def test_stages_keep_further_columns_and_names(spark, tmp_path):
    """Columns beside those of documents stay, also where their names are those of the stages' own; names may have any case."""
    corpus(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for more in (docs.selectExpr("*", "doc_id % 7 AS score", "'x' AS cls", "1 AS lociq_text", "array(1) AS x"), docs.selectExpr("doc_id", "text AS Text", "lang", "source AS Source", "n_chars AS N_Chars")):
        for stage in (corpus_pipeline.quality, corpus_pipeline.language):
            whole = {r.doc_id for r in stage(spark, docs, str(tmp_path)).collect()}
            got = stage(spark, more, str(tmp_path))
            assert got.columns == more.columns and {r.doc_id for r in got.collect()} == whole
    assert corpus_pipeline.language(spark, docs.drop("text"), str(tmp_path)).count() == 0


def test_language_rejects_noise_and_unlearned_languages(spark):
    rng = np.random.default_rng(12)
    parts = {"en": ["the", "ing", "and", "th", "er", "ou"], "de": ["sch", "ung", "ein", "ver", "ü", "ach"], "fr": ["eau", "oux", "que", "é", "les", "ai"]}
    text = lambda g, n: " ".join("".join(rng.choice(g, 3)) for _ in range(n))
    rows = [(k, text(parts[g], 4 if k % 10 == 0 else 40), g) for k, g in enumerate(list(parts) * 60)]
    noise = [" ".join("".join(rng.choice(list("bcdfgjklmpwxyz"), 6)) for _ in range(30)) for _ in range(40)]
    other = [text(["при", "ость", "ень", "ств", "ова"], 30) for _ in range(40)]
    odd = [(1000 + k, t, None) for k, t in enumerate(noise + other)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in language_id.known_language_only(docs).collect()}
    assert {k for k, *_ in rows} <= kept and len(kept & {k for k, *_ in odd}) <= 2
    assert len({r.doc_id for r in language_id.known_language_only(docs, 0.02).collect()} & {k for k, *_ in odd}) > 20
