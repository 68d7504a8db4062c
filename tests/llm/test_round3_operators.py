"""Exponion clustering, secret scans and the source audit: brute force, oracles and edge cases."""

import hashlib
import re
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lociq.llm import divergence, exponion, secret_scan
from lociq.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
NEW = ["op11_centroid_clusters", "op12_secret_scan", "op13_source_audit"]


@pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")
@pytest.mark.parametrize("name", NEW)
def test_new_operators_against_their_sql(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    got = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=repr) == sorted(cur.fetchall(), key=repr)


# clustering


def brute_clusters(rows, k, rounds, seed, dim, scale):
    kept = []
    for vec_id, e in rows:
        if e is None or len(e) != dim or any(x is None or not np.isfinite(x) or abs(x) >= exponion.LIMIT / scale for x in e):
            continue
        kept.append((vec_id, [int(np.floor(scale * float(x))) for x in e]))
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    c = [v for _, v in first]
    far = lambda v, w: sum((a - b) ** 2 for a, b in zip(v, w, strict=True))
    nearest = lambda v: min(range(len(c)), key=lambda j: (far(v, c[j]), j))
    for _ in range(rounds):
        at = [nearest(v) for _, v in kept]
        for j in range(len(c)):
            own = [v for (_, v), a in zip(kept, at, strict=True) if a == j]
            if own:
                c[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [(i, nearest(v), far(v, c[nearest(v)])) for i, v in kept] if c else []
    inertia = Counter()
    for _, a, d in found:
        inertia[a] += d
    digest = lambda j: hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()
    return sorted(((i, a, d, inertia[a], sum(inertia.values()), digest(a)) for i, a, d in found), key=repr)


def clustered(spark, rows, **how):
    df = spark.createDataFrame([(i, e, "x", 1, 2) for i, e in rows], "vec_id long, embedding array<double>, cluster string, v int, upper int")
    out = exponion.clusters(df, **how).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("kind", ["random", "lattice", "copies", "few", "large"])
def test_clusters_are_those_of_brute_force(spark, kind):
    rng = np.random.default_rng(7)
    dim = 4
    if kind == "random":
        rows = [(i, rng.normal(size=dim).tolist()) for i in range(300)]
    elif kind == "lattice":  # many equal distances
        rows = [(i, rng.integers(-1, 2, dim).astype(float).tolist()) for i in range(300)]
    elif kind == "copies":  # a third of all rows are one vector, so are some centroids
        rows = [(i, [0.5] * dim if i % 3 == 0 else rng.integers(0, 2, dim).astype(float).tolist()) for i in range(200)]
    elif kind == "few":
        rows = [(i, rng.normal(size=dim).tolist()) for i in range(5)]
    else:  # beyond the range in which doubles are exact
        rows = [(i, (rng.integers(-(1 << 26), 1 << 26, dim) / 64).tolist()) for i in range(100)]
    rows += [(None, [0.1] * dim), (900, None), (901, [1.0]), (902, [None] * dim), (903, [float("nan")] * dim), (904, [float("inf")] + [0.0] * (dim - 1)), (905, [1e300] * dim), rows[0], (906, [-0.001] * dim)]
    how = {"k": 16, "rounds": 3, "seed": 1, "dim": dim, "scale": 64}
    assert clustered(spark, rows, **how) == brute_clusters(rows, **how)


def test_no_vectors_and_one_centroid(spark):
    assert clustered(spark, []) == [] == clustered(spark, [(1, [1.0])])
    rows = [(i, [float(i), 0.0]) for i in range(9)]
    how = {"k": 1, "rounds": 2, "seed": 3, "dim": 2, "scale": 8}
    assert clustered(spark, rows, **how) == brute_clusters(rows, **how)
    with pytest.raises(ValueError):
        exponion.clusters(spark.createDataFrame([], "vec_id long, embedding array<float>"), k=exponion.MAX_CENTROIDS + 1)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 40), st.integers(1, 3), st.integers(0, 2**31), st.sampled_from([2, 5, 1000, 1 << 25]))
def test_bounds_never_lose_the_nearest(k, dim, seed, size):
    """Rounds with centroids that move by anything: the assignment is that of a full scan, ties to the smaller number."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-size, size, (80, dim))
    at, upper, lower = np.zeros(80, np.int32), np.full(80, np.inf), np.zeros(80)
    table = exponion.Centroids(rng.integers(-size, size, (k, dim)))
    for _ in range(4):
        exponion.assign(x, at, upper, lower, table)
        full = exponion.squared(x, table.c)
        assert (at == full.argmin(axis=1)).all()
        assert (upper**2 >= full.min(axis=1) * (1 - 1e-9)).all()
        table = exponion.Centroids(table.c + rng.integers(-size // 2, size // 2 + 1, (k, dim)) * (rng.random((k, 1)) < 0.5), table.c)


def test_most_centroids_are_not_looked_at():
    rng = np.random.default_rng(1)
    middle = rng.integers(-5000, 5000, (200, 8))
    x = middle[rng.integers(0, 200, 5000)] + rng.integers(-200, 200, (5000, 8))
    at, upper, lower, table = np.zeros(5000, np.int32), np.full(5000, np.inf), np.zeros(5000), exponion.Centroids(middle)
    exponion.assign(x, at, upper, lower, table)
    again = exponion.assign(x, at, upper, lower, exponion.Centroids(middle + 5, middle))
    assert again < 0.05 * 5000 * 200


# secret scans


BRUTE = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""".replace("(password|passwd|secret|token|api_?key)", "(?i:(password|passwd|secret|token|api_?key))")), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    ("private_key", re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"), bool),
    ("github", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"), bool),
    ("slack", re.compile(r"xox[abprs]-[A-Za-z0-9-]{20,}"), bool),
    ("jwt", re.compile(r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"), bool),
]


def brute_secrets(text):
    found = sorted((m.start(), k, m.end()) for k, (_, e, ok) in enumerate(BRUTE) for m in e.finditer(text or "") if ok(m))
    line = lambda spans: ",".join(f"{BRUTE[k][0]}:{a}:{z}" for a, k, z in spans)
    base = [f for f in found if f[1] < 3]
    return (*(sum(k == j for _, k, _ in base) for j in range(3)), hashlib.sha256(line(base).encode()).hexdigest(), line(found))


SECRETS = [
    None, "", "clean text about a token of thanks and a secret", 'PassWord = "hunter2hunter"', "api_key:abcdef apikey='x.y-z_1' API_KEY=abcde", "secret=token: abcdefgh", "token= token=abcdef token:",
    "AKIA" + "A" * 16 + " AKIA" + "B" * 15, "é" * 30 + "0123456789abcdef01234567é", "f" * 23 + " " + "f" * 24, "ghp_" + "a1" * 18, "xoxb-" + "1" * 20, "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + "." + "c" * 12,
    "-----BEGIN RSA PRIVATE KEY-----", "pass", "word = abcdefgh", "🙂 token = abcdefgh1 🙂 passwd:abcdefg", "x " * 700_000 + "secret: abcdefghi " + "deadbeef" * 3, "\x00token\x00=abcdefg", "tok", "en=abcdefgh", "SECRET'  :  'abcdef",
]


def test_secrets_are_those_of_brute_force(spark):
    rows = [(k, t, "a", 1) for k, t in enumerate(SECRETS)] + [(3, SECRETS[3], "b", 2), (None, SECRETS[4], None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, found string, spans int")
    got = sorted((tuple(r) for r in secret_scan.secret_digests(df).collect()), key=repr)
    assert got == sorted(((i, *brute_secrets(t)) for i, t, *_ in rows), key=repr)
    assert secret_scan.secret_digests(df.limit(0)).count() == 0
    spans = {r.doc_id: r.found for r in secret_scan.secret_spans(df.where("doc_id = 3")).collect()}
    assert [(f.kind, f.start, f.end) for f in spans[3]] == [("assign", 0, 25)]
    cut = {r.doc_id: r for r in secret_scan.redacted(df.withColumnRenamed("text", "Text")).collect()}
    assert cut[3].Text == '[assign]"' and cut[2].Text == SECRETS[2] and cut[0].Text is None and cut[3].spans in (1, 2)
    assert cut[11].Text == "[slack]"


def test_queries_hold_for_every_match_and_look_at_few_texts():
    texts = pa.array([t or "" for t in SECRETS] + ["ordinary words of a clean text"] * 200)
    found, looked = secret_scan.matcher(secret_scan.RULES).scan(texts)
    assert looked < 25 and sum(map(bool, found)) > 12
    assert secret_scan.trigram_query(r"[0-9a-f]{24,}") is True  # no trigram must occur, so all texts are scanned
    assert secret_scan.trigram_query(r"abc+d?e*") == b"abc"
    assert secret_scan.trigram_query(r"(?:abcd|x)y") is True
    assert secret_scan.trigram_query(r"abcd|efg") == ("or", frozenset({("and", frozenset({b"abc", b"bcd"})), b"efg"}))


PIECES = st.sampled_from(["a", "b", "ab", "abc", "[ab]", "[a-z]", ".", "B", "é"])
PATTERNS = st.recursive(PIECES, lambda p: st.one_of(st.tuples(p, p).map("".join), st.tuples(p, p).map(lambda t: f"(?:{t[0]}|{t[1]})"), st.tuples(p, st.sampled_from(["*", "+", "?", "{2}", "{2,}", "{0,3}", "{5}"])).map(lambda t: f"(?:{t[0]}){t[1]}")), max_leaves=7)


@settings(max_examples=300, deadline=None)
@given(PATTERNS, st.text(alphabet="abBcxé", max_size=14))
def test_a_text_that_matches_fulfils_the_query(pattern, text):
    rule = (secret_scan.Rule("r", pattern),)
    found, _ = secret_scan.Matcher(rule).scan(pa.array([text, "zz"]))
    want = [(m.start(), 0, m.end()) for m in re.finditer(pattern, text)] if text else []
    assert found[0] == want


# source audit


def brute_audit(rows, least=10, top=10):
    docs = [(t or "", g or "", s or "") for t, g, s in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [re.findall(divergence.PATTERN, t.translate(lower)) for t, _, _ in docs]
    out = []
    for lang in {g for _, g, _ in docs}:
        df, count = Counter(), defaultdict(Counter)
        for (_, g, s), w in zip(docs, words, strict=True):
            if g == lang:
                df.update(set(w))
                count[s].update(w)
        kept = sorted(t for t, n in df.items() if n >= least)
        share = lambda n, total: 1 + 1_000_000_000 * (n + 2) // (total + 2 * len(kept))  # noqa: B023, E731
        p = {s: {t: share(c[t], sum(c[x] for x in kept)) for t in kept} for s, c in count.items()}
        whole = sum(count.values(), Counter())
        q = {t: share(whole[t], sum(whole[x] for x in kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in count:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in count if o != s), key=lambda x: (x[0], x[1].encode()))
            terms = sorted(((-f(p[s][t], q[t]), t) for t in kept if count[s][t] and p[s][t] > q[t]), key=lambda x: (x[0], x[1].encode()))[:top]
            out += [(lang, s, part, item, -v, k) for part, found in (("pair", pairs), ("term", terms)) for k, (v, item) in enumerate(found, 1)]
    return sorted(out)


def audited(spark, rows, **how):
    df = spark.createDataFrame([(t, g, s, 1, "z") for t, g, s in rows], "text string, lang string, source string, n int, term string")
    out = divergence.source_audit(df, **how).select("lang", "source", "part", "item", "value", "rank")
    return sorted(tuple(r) for r in out.collect())


def test_audit_is_that_of_brute_force(spark):
    rng = np.random.default_rng(3)
    vocabulary = ["the", "THE", "cat", "Ünder", "don't", "x1y", "é", "東京", "rare", "zz", "a", "b"]
    rows = [(" ".join(rng.choice(vocabulary, rng.integers(0, 30))), ["en", "de", None][i % 3], [f"s{i % 5}", None, ""][i % 7 % 3]) for i in range(180)]
    rows += [(None, "en", "empty"), ("", "xx", "only"), ("few words", "yy", "a"), ("few", "yy", "b"), ("the " * 5000, "en", "s1"), rows[0], rows[0]]
    assert audited(spark, rows) == brute_audit(rows)
    assert audited(spark, rows, least_docs=1, top=3) == brute_audit(rows, 1, 3)
    assert audited(spark, []) == []


def test_audit_with_several_blocks_of_sources(spark, monkeypatch):
    """More sources than a block, most of them without most terms."""
    rng = np.random.default_rng(5)
    rows = [(" ".join(f"w{'abcdefghij'[int(x)]}" for x in rng.integers(0, 10, 3)), "en", f"s{i % 150}") for i in range(400)]
    assert audited(spark, rows) == brute_audit(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abA é1\n東", max_size=30), min_size=1, max_size=8), st.integers(4, 20))
def test_terms_of_slices(texts, limit):
    """Also a text that is cut into slices counts as one document."""
    counts, real = divergence.TermCounts(), divergence.slices
    divergence.slices = lambda data, off: real(data, off, limit)
    try:
        counts.add(pa.array(texts), np.zeros(len(texts), np.int64))
    finally:
        divergence.slices = real
    got = {t: (n, d) for b in counts.batches() for t, n, d in zip(*(b.column(k).to_pylist() for k in (2, 3, 4)), strict=True)} if counts.groups.setdefault(("", ""), 0) == 0 else {}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [re.findall(divergence.PATTERN, t.translate(lower)) for t in texts]
    n, d = Counter(x for w in words for x in w), Counter(x for w in words for x in set(w))
    assert got == {t: (n[t], d[t]) for t in n}


def test_shares_stay_exact_for_huge_counts(spark):
    from pyspark.sql import functions as F

    for n, total, v in [(0, 0, 1), (7, 100, 3), (4_000_000_000_000_000, 8_999_999_999_999_999, 100), (10**15, 10**15, 1)]:
        want = 1 + 10**9 * (n + 2) // (total + 2 * v)
        assert divergence.shares(np.array([n]), np.array([total]), v)[0] == want
        got = spark.range(1).select(F.expr(divergence._share(f"{n}L", f"{total}L", f"{v}L"))).first()[0]
        assert got == want


def test_language_pieces_change_nothing():
    from lociq.llm.language_id import Profiles

    texts = ["the quick brown fox", None, "", "über die Straße", "привет мир " * 50, "12 34", "a"]
    whole, lettered = Profiles(256).bundle(texts)
    for piece in (1, 20, 600):
        vectors, found = Profiles(256).bundle(texts, piece)
        assert (vectors == whole).all() and (found == lettered).all()


def test_vector_tables_sum_the_products_of_both_halves():
    from lociq.llm import vector_search

    rng = np.random.default_rng(3)
    for d in (5, 64, 768):
        x = rng.normal(size=(40, d))
        books = vector_search.fit_codebooks(x, rounds=1)
        codes = books.encode(x)
        packed = (codes[:, 0::2] | codes[:, 1::2] << 4).T
        tables = books.tables(x[:7])
        assert tables.nbytes <= 7 * 32 * (d + 4)
        near = sum(vector_search._byte_table(tables, b)[:, packed[b]] for b in range(len(packed)))
        shown = np.stack([books.centers[m][codes[:, m]] for m in range(len(books.centers))], axis=1).reshape(40, -1)[:, :d]
        assert np.allclose(near, x[:7] @ shown.T, atol=1e-3)


def test_vector_waves_stay_within_their_bytes():
    from lociq.llm.vector_search import OPEN_BLOCKS, QUERY_BLOCK, WAVE_BYTES, wave_blocks

    assert wave_blocks(64, 500) == OPEN_BLOCKS
    for d in (256, 768, 4096):
        assert 1 <= wave_blocks(d, 2000) and wave_blocks(d, 2000) * QUERY_BLOCK * (40 * d + 12 * 2000) <= WAVE_BYTES


def test_batches_are_bounded_and_never_enlarged(spark):
    from lociq.llm import common

    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    before = {k: spark.conf.get(k) for k in (rows, size)}
    try:
        for given, want in (("64MB", str(common.BATCH_BYTES)), ("1m", "1m"), ("4096", "4096")):
            spark.conf.set(size, given)
            common.small_batches(spark)
            assert spark.conf.get(size) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("kind", ["tight", "lengths", "offset", "nested"])
def test_vector_search_finds_the_nearest_of_other_rows(spark, kind):
    """Groups much tighter than their distances, lengths of many sizes, a place far from the origin, groups within groups: few are reranked."""
    from lociq.llm import vector_search

    rng = np.random.default_rng(4)
    n, d = 4000, 16
    noise, centre = rng.normal(size=(n, d)), rng.normal(size=(6, d))
    x = {
        "tight": lambda: centre[rng.integers(0, 6, n)] + 1e-3 * noise,
        "lengths": lambda: noise * np.exp(3 * rng.normal(size=(n, 1))),
        "offset": lambda: noise + 1000,
        "nested": lambda: 10 * centre[rng.integers(0, 6, n)] + (0.3 * rng.normal(size=(30, d)))[rng.integers(0, 30, n)] + 0.005 * noise,
    }[kind]()
    found = vector_search.nearest(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>"), rerank=100, sample=2000).collect()
    far = np.sqrt(((x[None, ::100] - x[:, None]) ** 2).sum(axis=2))
    want = {(q, v) for k, q in enumerate(range(0, n, 100)) for v in [v for v in np.argsort(far[:, k]) if v != q][:10]}
    assert len({(r.query_id, r.vec_id) for r in found} & want) >= 0.9 * len(want)


def test_bpe_cuts_ascii_pieces_without_the_library():
    import random

    from lociq.llm import trie_bpe
    from lociq.llm.queries import tokenizer_path

    path = tokenizer_path("word_bpe_49k.json")
    encoder, library = trie_bpe.PieceEncoder(path), trie_bpe.load_tokenizer(path)
    rng = random.Random(5)
    signs = "aabcdehilmnorstTVDS'''\"0129.,-_()[]{}\\/^$|?*+<>&%#@!~`;:="
    pieces = ["".join(rng.choices(signs, k=rng.randint(1, 14))) for _ in range(3_000)] + ["it's", "WE'VE", "'", "x\x1fy", "\x7f", "<|endoftext|>a", "naïve", "a b"]
    want = [library.encode(p, add_special_tokens=False).ids for p in pieces]
    assert encoder.encode(pieces) == want
    encoder.tk = None  # pieces of printable ASCII signs need it no more
    assert encoder.encode(["don't", "x=3;", "(y)"]) == [library.encode(p, add_special_tokens=False).ids for p in ("don't", "x=3;", "(y)")]
