"""Operators of the training-data part: brute force, round trips, held-out accuracy and edge cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lociq.llm import html_extract, jaccard_join, language_id, media_copies, mixing, quality, token_counts, token_store, trie_bpe, vector_search
from lociq.llm.words import slices, text_buffers, word_bounds

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, n int, cls string, target string"
ODD = [
    None, "", "   \n", "a", "Hello,  world! don't", "<|endoftext|> x <|startoftext|>y", "ÉCOLE é ﬁ ǅ", "　wide space x ", "🙂🙂 x🙂", "１２ 3³ ٣", "á ́b", "x" * 5000,
    "the cat " * 3000, "\x00 nul \x1c sep", "same text twice here now", "same text twice here now", "it's we'll I'M 'S", "#$%^ ### ---",
]


def frame(spark, texts=ODD):
    rows = [(k, t, "en" if k % 3 else None, None if k % 5 == 0 else f"s{k % 3}", None if t is None else len(t), 1, 2, "c", "t") for k, t in enumerate(texts)]
    rows += [rows[-1], (None, "null id words are here too", None, None, None, None, None, None, None)] if texts else []
    return spark.createDataFrame(rows, DOCS)


def library(path, text):
    tk = token_counts.load_tokenizer(path)
    ids = tk.encode(text or "", add_special_tokens=False).ids
    return ids, tk.decode(ids, skip_special_tokens=False)


def test_words_are_those_of_the_pattern():
    texts = [t or "" for t in ODD] + ["", "end"]
    for limit in (16, 100, 1 << 20):
        data, off, _ = text_buffers(pa.array(texts))
        got = defaultdict(list)
        for s in slices(data, off, limit):
            starts, ends, first = word_bounds(s)
            for r, a, z in zip(s.rows.tolist(), first[:-1], first[1:], strict=True):
                got[r] += [s.data[x:y].tobytes().decode() for x, y in zip(starts[a:z], ends[a:z], strict=True)]
        assert [got[k] for k in range(len(texts))] == [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]


def test_token_counts(spark):
    got = token_counts.token_counts(frame(spark), WORD, huge_bytes=2000, chunk_chars=700, overlap_chars=8).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        text = ODD[r.doc_id] if r.doc_id is not None else "null id words are here too"
        n = len(library(WORD, text)[0])
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((text or "").encode()), n > 2048)
    assert token_counts.token_counts(frame(spark, []), WORD).count() == 0


def test_texts_without_white_space_take_time_in_proportion():
    """Runs of letters with few or no stable boundaries: encoded characters stay below a fixed multiple of the text's."""
    tk = token_counts.load_tokenizer(WORD)
    rng = np.random.default_rng(2)
    for text in ("一二三" * 20_000, "".join(rng.choice(list("一二三四五六七八九十，。"), 60_000)), "ab1" * 20_000):
        seen = []

        def offsets(part):
            seen.append(len(part))
            return tk.encode(part, add_special_tokens=False).offsets

        assert token_counts.splice_count(offsets, text) == len(tk.encode(text, add_special_tokens=False).ids)
        assert sum(seen) < 3 * len(text)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab ,.'é\n Z9", max_size=300), st.integers(4, 40), st.integers(1, 10))
def test_splicing(text, chunk, overlap):
    tk = token_counts.load_tokenizer(WORD)
    count = token_counts.splice_count(lambda part: tk.encode(part, add_special_tokens=False).offsets, text, chunk, min(overlap, chunk - 1))
    assert count == len(tk.encode(text, add_special_tokens=False).ids)


def test_bpe(spark):
    got = trie_bpe.bpe_digests(frame(spark), WORD).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in got:
        ids, text = library(WORD, ODD[r.doc_id] if r.doc_id is not None else "null id words are here too")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(text))
    for r in trie_bpe.bpe_encode(frame(spark), WORD).where("doc_id IS NOT NULL").collect():
        assert (r.ids, r.decoded) == library(WORD, ODD[r.doc_id])
    assert trie_bpe.bpe_digests(frame(spark, []), WORD).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abcdeinrsth", min_size=1, max_size=24), min_size=1, max_size=20))
def test_trie_is_plain_merging(words):
    encoder = _encoder()
    got = encoder.encode(words)
    for w in words:
        symbols = [*w[:-1], w[-1] + "</w>"]
        assert got[w] == encoder.merge([encoder.vocab[c] for c in symbols])


def _encoder(cache={}):  # noqa: B006
    if not cache:
        cache["e"] = trie_bpe.PieceEncoder(WORD).bpe
    return cache["e"]


def test_token_store(spark, tmp_path):
    docs = frame(spark)
    uri, dictionary = token_store.write_store(docs, BYTE, f"file://{tmp_path}/store")
    got = token_store.read_store(spark, uri, dictionary).collect()
    assert len(got) == len(ODD) + 2
    rows = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, *range(len(ODD)), len(ODD) - 1]
    start = 0
    for r in rows:
        ids = np.array(library(BYTE, ODD[r.doc_id] if r.doc_id is not None else "null id words are here too")[0] + [0], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    first = spark.read.parquet(f"{uri}/manifest").orderBy("shard").first()
    assert token_store.read_document(uri, first.file, dictionary, 0).tolist() == library(BYTE, "null id words are here too")[0] + [0]
    assert token_store.token_store(frame(spark, []), BYTE).count() == 0
    with pytest.raises(ValueError):
        token_store.read_document(uri, first.file, b"other", 0)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    find = lambda x: x if root[x] == x else find(root[x])
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 75 * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(len(s), find(k)) for k, s in enumerate(sets)]


def near_copies(seed, n=160):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    base = [[vocabulary[k] for k in rng.integers(0, 60, 40)] for _ in range(6)]
    common = " ".join(vocabulary[k] for k in rng.integers(0, 60, 30))
    texts = []
    for k in range(n):
        words = list(base[k % 6]) if k % 3 else [vocabulary[i] for i in rng.integers(0, 60, 40)]
        for _ in range(rng.integers(0, 3)):
            words[rng.integers(0, len(words))] = vocabulary[rng.integers(0, 60)]
        texts.append(" ".join(words) + (" " + common if k % 4 == 0 else ""))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components(spark, seed):
    texts = near_copies(seed) + [None, "", "  ", "A b", "a B", "a b c", "a b c d", "One two Three four five", "one two three four FIVE", "x " * 9, "x " * 30]
    rows = [(k, t, 1, "x") for k, t in enumerate(texts)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string, n int, cls string")).collect()}
    assert [got[k] for k in range(len(texts))] == brute_components(texts)


def test_jaccard_odd_rows(spark):
    d = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (2, None), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(d).collect()), key=repr)
    assert got == sorted([(5, 2, 5), (5, 2, 5), (None, 2, 5), (2, 0, 2), (None, 0, None)], key=repr)
    assert jaccard_join.jaccard_components(d.limit(0)).count() == 0


def test_mixing(spark):
    rng = np.random.default_rng(0)
    rows = [(k, " ".join(["w"] * int(rng.integers(0, 60))), "abcd"[k % 4] if k % 7 else None) for k in range(400)] + [(400, None, "a"), (401, "x y", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = mixing.mixed_amounts(docs, block_words=32).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        assert r.size == len((rows[r.doc_id][1] or "").split()) and 0 <= r.taken <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert len(got) == len(rows) and sum(target.values()) == pytest.approx(sum(sizes.values()))
    for s, t in target.items():
        assert t <= 3 * sizes[s] + 1e-6 and abs(taken[s] - t) <= 1
    again = mixing.mixed_amounts(docs.repartition(3), block_words=32).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    copies = Counter(r.doc_id for r in mixing.mixed_documents(docs).collect())
    want = {r.doc_id: int(r.taken / r.size + 0.5) for r in mixing.mixed_amounts(docs).collect() if r.taken}
    assert {k: v for k, v in want.items() if v} == dict(copies)
    assert mixing.mixed_amounts(docs.limit(0)).count() == 0


def test_mixed_documents_with_clashing_columns_and_repeats(spark):
    text = lambda n: " ".join(f"w{k}" for k in range(n))
    rows = [(k, text(50 + k), "abc"[k % 3], k, k + 1, "r", 3) for k in range(30)] + [(5, text(55), "c", 70, 71, "r", 3)] * 2 + [(None, text(40), None, 1, 2, "r", 4), (8, None, "a", 5, 5, "r", 4), (9, "x" * 200_000, "b", 9, 9, "r", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, copies long, row string, turn int")
    amounts = Counter()
    for r in mixing.mixed_amounts(docs).collect():
        amounts[r.doc_id, r.source, r.size] += int(r.taken / r.size + 0.5) if r.size else 0
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    found = Counter((r.doc_id, r.source, len((r.text or "").split())) for r in got.collect())
    assert found == +amounts and (8, "a", 0) not in found


def test_schedule_is_low_discrepancy(spark):
    docs = spark.createDataFrame([(k, "w " * 100, "ab"[k % 2]) for k in range(200)], "doc_id long, text string, source string")
    _, parts = mixing.mix(docs, block_words=10)
    order = [r.sid for r in parts.select("slot", "sid").distinct().orderBy("slot").collect()]
    share = order.count(0) / len(order)
    ahead = [abs(sum(s == 0 for s in order[: k + 1]) - share * (k + 1)) for k in range(len(order))]
    assert max(ahead) <= 4


def test_language_id(spark):
    rng = np.random.default_rng(3)
    parts = {"en": ["the", "ing", "and", "th", "er"], "de": ["sch", "ung", "ein", "ver", "ü"], "fr": ["eau", "oux", "que", "é", "les"]}
    word = lambda g: "".join(rng.choice(parts[g], 3))
    rows = [(k, " ".join(word(g) for _ in range(30)), g) for k, g in enumerate(list(parts) * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.identify_languages(docs).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {k for k, *_ in rows if zlib.crc32(str(k).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == rows[r.doc_id][2] for r in held]) >= 0.97 and all(0 <= r.score <= 1 for r in got)
    odd = {r.doc_id: r for r in language_id.identify_languages(frame(spark)).where("doc_id IS NOT NULL").collect()}
    assert [odd[k].lang_pred for k in (0, 1, 2)] == ["und"] * 3 and odd[17].lang_pred == "und" and odd[4].lang_pred == "en"
    assert language_id.identify_languages(frame(spark, [])).count() == 0
    assert {r.lang_pred for r in language_id.identify_languages(docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).collect()} == {"und"}


def test_quality(spark):
    rng = np.random.default_rng(4)
    good = lambda: " ".join(rng.choice(["stone", "river", "and", "the", "runs", "over"], 40)) + "."
    bad = lambda: " ".join(f"{w}###" for w in rng.choice(["stone", "river", "and"], 40))
    rows = [(k, good() if k % 3 else bad(), "en", f"s{k % 3}", 99) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(150)], "doc_id long, quality int, toxic int")
    got = quality.score_documents(docs, labels).collect()
    assert np.mean([r.accepted == (r.doc_id % 3 > 0) for r in got if r.doc_id >= 150]) >= 0.98
    assert {r.doc_id for r in quality.good_documents(docs, labels).collect()} == {r.doc_id for r in got if r.accepted}
    none = quality.score_documents(frame(spark), labels.limit(0)).collect()
    assert len(none) == len(ODD) + 2 and all(r.accepted and r.score == 0.5 for r in none)
    assert quality.score_documents(frame(spark), labels).count() == len(ODD) + 2
    assert quality.score_documents(frame(spark, []), labels).count() == 0


def test_a_round_of_co_training_by_brute_force(spark):
    rng = np.random.default_rng(9)
    word = lambda k: " ".join(rng.choice(["stone", "river", "and", "the", "runs", "over", "42", "a-b", "!!"][: 3 + k % 7], 20 + k % 11))
    rows = [(k, word(k) + ("." if k % 3 else " ###$$$ ||"), "en" if k % 4 else "de", f"s{k % 3}" if k % 5 else "mixed", 90 + k) for k in range(240)]
    docs = spark.createDataFrame([*rows, *rows[200:210]], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(60)], "doc_id long, quality int")
    got = quality.train(docs.repartition(5), labels, rounds=1, per_round=15)
    t = quality.text_features(pa.array([r[1] for r in rows])).astype(np.float32).astype(np.float64)
    m = quality.meta_features(*(pa.array([r[c] for r in rows]) for c in (3, 2, 4)))
    order = [r[0] for r in spark.range(60).selectExpr("id", "xxhash64(id) AS p").orderBy("p").collect()]
    y = np.array([float(k % 3 > 0) for k in order])
    model = quality.fitted(t[order], m[order], y, {"text": (t[:0], y[:0]), "meta": (m[:0], y[:0])})
    new = np.arange(60, 240)
    both = np.hstack([t, m])[new].astype(np.float32)
    odds_t, odds_m, _ = model.odds(t[new], m[new])
    top_t, top_m = quality.surest(odds_t, both, 15), quality.surest(odds_m, both, 15)
    want = quality.fitted(t[order], m[order], y, {"meta": (m[new][top_t], (odds_t[top_t] > 0).astype(float)), "text": (t[new][top_m], (odds_m[top_m] > 0).astype(float))})
    assert len(top_t) and len(top_m)
    assert all(np.allclose(a, b, atol=1e-3) for a, b in zip(got.odds(t, m), want.odds(t, m), strict=True))
    again = quality.train(docs.repartition(2), labels, rounds=1, per_round=15)
    assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(got.odds(t, m), again.odds(t, m), strict=True))


def test_vector_search(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    x[700:760] = x[100]
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(2000, None), (2100, [0.0] * 24), (2200, [float("nan")] * 24), (2300, [1.0, None]), (2400, []), (100, x[100].tolist()), (None, x[3].tolist())]
    got = defaultdict(list)
    for r in vector_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 1500, 100))
    hit = 0
    for q, found in got.items():
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        want = [k for k in np.lexsort((np.arange(1500), d)) if k != q][:10]
        hit += len({v for _, v, _ in found} & set(want))
        assert [k for k, _, _ in found] == list(range(1, 11)) and all(abs(s - d[v]) < 1e-12 for _, v, s in found)
    assert hit >= 0.95 * 10 * len(got) and [v for _, v, _ in got[100]] == list(range(700, 710))
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 3.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in vector_search.nearest(few).collect()] == [(0, 1, 1, 1.0)]
    assert vector_search.nearest(few.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body><nav><a>Menu</a></nav><!-- x --><div class="cookie-notice">We use</div>
<div id="sidebar"><p>side</p></div><article><header><h1>Head &amp; tail</h1></header><p>One <b>bold</b>
 text<br>more<p>Two&nbsp;&lt;x&gt;<div class="comments"><p>first!</p></div><p>{}</p></article><form><input>go</form><footer>&copy; f</footer></body></html>"""


def test_html(spark):
    rows = [(1, "http://h/a", PAGE.format("Three")), (2, "http://h/b", PAGE.format("Three")), (3, None, None), (4, "x", "plain  text"), (5, "http://k/1", "<div>Logo</div><p>Story one is here</p><p>More of it</p><div>Bottom</div>"), (6, "http://k/2", "<div>Logo</div><p>Another story</p><p>And more</p><p>Still</p><div>Bottom</div>")]
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    body = "Head & tail\n\nOne bold text more\n\nTwo <x>\n\nThree"
    assert got[1] == got[2] == (body, len(body)) and got[3] == ("", 0) and got[4][0] == "plain text"
    assert got[5][0] == "Story one is here\n\nMore of it" and got[6][0] == "Another story\n\nAnd more\n\nStill"


def html_of(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in html_extract.extract_main_text(frame.repartition(3)).collect()}


def test_html_differencing_takes_part_on_every_page(spark):
    article = "<article><p>Share this story with friends</p><p>Story number {0} is told here at length</p>{1}</article><p>Standfirst {0}</p><p>Imprint</p>"
    rows = [(k, f"http://h/{k}", article.format(k, "<p>A passage of two</p>" if k in (3, 4) else "")) for k in range(1, 8)]
    template = "".join(f"<p>Template {w}</p>" for w in "abcd")
    loose = lambda k: template + "".join(f"<p>Body {w} of page {k}</p>" for w in "xyz")
    rows += [(11, "http://k/1", loose(1)), (12, "http://k/2", loose(1)), (13, "http://k/3", loose(3))]
    got = html_of(spark, rows)
    for k in range(1, 8):
        assert got[k] == "\n\n".join([f"Story number {k} is told here at length", *(["A passage of two"] if k in (3, 4) else []), f"Standfirst {k}"])
    for k, body in ((11, 1), (12, 1), (13, 3)):
        assert got[k] == "\n\n".join(f"Body {w} of page {body}" for w in "xyz")


def test_html_by_brute_force_on_pages_without_zones(spark):
    """Pages without article or main, and all within main: exactly the lines stay that the nearest URL of the host has not, in order."""
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for h in range(6):
        shared = [f"Host {h} line {w}" for w in range(4)]
        paths = sorted(f"/{rng.integers(3)}/{k:02}?id={rng.integers(9)}" for k in range(9))
        for k, path in enumerate(paths):
            own = [f"Own {h} {k} {w} of this page" for w in range(2 + k % 3)]
            order = [*shared[:2], *own[:1], shared[2], *own[1:], shared[3]]
            page = "".join(f"<p>{x}</p>" for x in order)
            rows.append((h * 100 + k, f"http://h{h}{path}", f"<main>{page}</main>" if h % 2 else f"<div class='share-price'>{page}</div>", 1, "z"))
            want[h * 100 + k] = "\n\n".join(own)
    frame = spark.createDataFrame([*rows, rows[0], rows[0]], "page_id long, url string, html string, part int, host string")
    got = html_extract.extract_main_text(frame.repartition(3)).collect()
    assert len(got) == len(rows) + 2 and {r.page_id: r.text for r in got} == want
    whole = "<article><p>" + "long text " * 60_000 + "</p><div class='ad-slot'>Buy</div><div class='ad-hoc'>Kept</div></article>"
    long = html_extract.extract_main_text(spark.createDataFrame([(1, "http://a/1", whole)], "page_id long, url string, html string")).first()
    assert long.text == ("long text " * 60_000).strip() + "\n\nKept"


def test_html_runs_of_copies_across_ranges(spark, monkeypatch):
    """A run of copies that fills several ranges is compared with the page before it, or at the host's beginning with the one after it."""
    monkeypatch.setattr(html_extract, "RANGE", 8)
    one, other, copy = "<p>Logo</p><p>One</p>", "<p>Logo</p><p>Other</p><p>Foot</p>", "<p>Logo</p><p>The same</p><p>Foot</p>"
    rows = [(k, f"http://{h}/{k:03}", page) for h, pages in (("a", [one, other] + [copy] * 60), ("b", [copy] * 60 + [one] * 20 + [other]), ("c", [copy] * 30)) for k, page in enumerate(pages, 1000 * ord(h))]
    got = html_of(spark, rows)
    text = lambda h: [got[k] for k in sorted(got) if k // 1000 == ord(h)]
    assert text("a") == ["One", "Other\n\nFoot"] + ["The same"] * 60
    assert text("b") == ["The same\n\nFoot"] * 60 + ["One"] * 20 + ["Other\n\nFoot"]
    assert text("c") == ["Logo\n\nThe same\n\nFoot"] * 30


def test_html_neighbours_in_a_large_host(spark):
    rows = [(k, f"http://h/s{k // 4:04}/{k:05}", f"<p>Section {k // 4} has this template</p><p>Page {k} says something of its own</p>") for k in range(1200)]
    got = html_of(spark, rows)
    assert sum("template" not in got[k] for k in range(1200) if k % 4) == 900
    first = html_of(spark, [*rows[:3], (9, "http://a/1", "<p>Logo of a</p><p>One</p>"), (10, "http://a/2", "<p>Logo of a</p><p>Two</p>")])
    assert first[9] == "One" and first[10] == "Two" and all("template" not in first[k] for k in range(3))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12))
def test_shared_lines_are_longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    found = html_extract.shared_lines(a, b)
    assert len(found) == table[-1][-1]
    it = iter(b)
    assert all(a[k] in it for k in sorted(found))


def test_media(spark):
    rows = [(k, [float(k // 2 if k > 60 else k)] * 4) for k in range(80)]
    media = media_copies.rendered_media(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    extra = spark.createDataFrame([(900, None), (901, b"not an image"), (902, b"not an image"), (903, b"P5 3 2 255\n123456")], "media_id long, image binary")
    got = {r.media_id: r for r in media_copies.media_groups(media.unionByName(extra)).collect()}
    for k in range(80):
        assert got[k].group_id == (k - k % 8 if k % 8 < 4 else got[k].class_id)
    assert got[69].class_id == 68 and got[900].group_id == 900 and got[902].group_id == 901 and got[903].n_features == 0
    assert media_copies.media_groups(extra.limit(0)).count() == 0


def test_media_finds_crops_and_turns_as_brute_force_does(spark):
    """Crops to 60 % and 80 % of the side and quarter turns of 40 pictures: at least 0.9 of each kind, and no pair that comparing all pairs denies."""
    rng = np.random.default_rng(3)
    kinds = {1: lambda a: a, 2: lambda a: a[:58, -58:], 3: lambda a: a[9:86, 9:86], 4: np.rot90}
    images = {}
    for k in range(40):
        a = np.rint(media_copies.picture(9000 + k))
        images |= {k * 10 + kind: media_copies.as_pgm(edit(a)) for kind, edit in kinds.items()}
        images[k * 10 + 5] = media_copies.as_pgm(np.clip(rng.normal(128, 40, (60, 60)), 0, 255))
    rows = [(i, raw, "x", 7, "y") for i, raw in images.items()] + [(11, images[11], "z", 8, "w")]
    got = {r.media_id: r.group_id for r in media_copies.media_groups(spark.createDataFrame(rows, "media_id long, image binary, cls string, token int, label string")).collect()}
    features = {i: media_copies.describe(media_copies.read_image(raw)) for i, raw in images.items()}
    for kind in (2, 3, 4):
        assert sum(got[k * 10 + kind] == got[k * 10 + 1] for k in range(40)) >= 36
    assert all(got[k * 10 + 5] == k * 10 + 5 for k in range(40))
    ids = sorted(images)[:100]
    brute = {(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if media_copies.agreeing(features[a], features[b]) >= media_copies.AGREE}
    assert all(a // 10 == b // 10 for a, b in brute)
    assert all(got[a] // 10 == a // 10 for a in ids)


def test_link_lists_in_a_hot_list(spark):
    """One list of 1,200 rows in 12 components that cross each other in every order, and a list that links with it."""
    from lociq.llm import graph

    n = 1200
    rows = [(7, 1 + k % 6, k, 40 + k % 9, 30, 60) for k in range(n)] + [(8, 0, k, 40 + k % 9, 30, 60) for k in (0, n, n + 1)]
    posts = spark.createDataFrame(rows, "token long, salt int, cls long, n int, lo int, hi int")

    def verified(pairs):
        return pairs.where(f"(a % 12 = b % 12 AND b < {n}) OR (a = 0 AND b = {n + 1})")

    labels = {r.cls: r.label for r in graph.link_lists(posts, verified).collect()}
    assert all(labels[k] == k % 12 for k in range(n)) and labels[n + 1] == 0 and n not in labels


def test_rows_without_a_doc_id_link_and_stay(spark):
    words = [f"w{k}" for k in range(60)]
    near = lambda *at: " ".join("changed" if k in at else w for k, w in enumerate(words))
    rows = [(None, near(), 1), (3, near(10), 2), (4, near(50), 3), (5, "another text of some words that is unlike all others", 4), (5, near(10), 5), (None, "alone without an id it stays here", 6), (9, None, 7), (9, None, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, turn int")
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert got[4, 56] == got[3, 56] == got[None, 56] == 3  # 3 and 4 meet through the row without an id only
    kept = sorted(r.turn for r in jaccard_join.one_of_each(docs).collect())
    assert kept in ([2, 4, 6, 7], [2, 4, 6, 8], [4, 5, 6, 7], [4, 5, 6, 8])
