"""What workers keep, and which lists later rounds of the set join read."""

import pyarrow as pa
import public_tokenizers
from pyspark.sql import functions as F

from lociq.llm import graph, trie_bpe


def test_encoder_gives_memory_back_after_each_batch(monkeypatch):
    calls = []
    monkeypatch.setattr(trie_bpe, "give_back", lambda: calls.append(1))
    monkeypatch.setattr(trie_bpe, "CACHE", 3)
    monkeypatch.setattr(trie_bpe, "_WORKER", {})
    run = trie_bpe.encode_batches(public_tokenizers.path("word_bpe_49k.json"))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one two three four", "five six one two"])], names=["doc_id", "text"])
    out = [b.to_pylist() for b in run(iter([batch] * 3))]
    assert out[0] == out[1] == out[2]
    assert len(calls) == 4  # after the file has been read, and after each batch


def test_rounds_read_undecided_lists_only(spark, monkeypatch):
    """Two classes are similar if both are even or both odd; list 1 is one component after the first links, in list 2 no neighbours are similar."""
    rows = [(1, 0, c, 100, 75, 133) for c in range(100, 120, 2)] + [(2, 0, c, 100, 75, 133) for c in range(201, 301)]
    posts = spark.createDataFrame(rows, "token long, salt int, cls long, n int, lo int, hi int")
    seen, before = [], graph._undecided

    def undecided(posts, labels):
        seen.append({r[0] for r in posts.select("token").distinct().collect()})
        return before(posts, labels)

    monkeypatch.setattr(graph, "_undecided", undecided)
    alike = lambda pairs: pairs.where(F.col("a") % 2 == F.col("b") % 2)
    labels = {r[0]: r[1] for r in graph.link_lists(posts, alike).collect()}
    assert labels == {c: 100 if c < 200 else 202 - c % 2 for _, _, c, *_ in rows}
    assert seen[0] == {1, 2} and all(s == {2} for s in seen[1:]) and len(seen) > 1
