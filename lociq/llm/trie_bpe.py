"""BPE encoding by prefix-sharing trie traversal, and decoding.

For a merge table, the encoding of a word is fixed by the last token of each of its prefixes: the
last token of prefix p is the one token t that ends p and for which (last token of p without t, t)
is a pair that merging leaves alone. Distinct words go into a trie of symbols; one depth-first walk
carries the stack of last tokens along the path, so that prefixes that words share are solved once.
Walking back over the stack gives a word's tokens.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lociq.llm.common import give_back, pick, released, small_batches
from lociq.llm.token_counts import CACHED_BYTES, load_tokenizer
from lociq.llm.words import distinct_ranges, slices, text_buffers, word_bounds

#: Pairs of tokens whose compatibility a worker remembers; then it starts anew.
PAIRS = 250_000
#: Pieces, and words, that a worker remembers (about 400 bytes each); then it starts anew.
CACHE = 200_000


class TrieBpe:
    """Encodes words (strings in the byte-level alphabet) with the merges of a tokenizers file."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = "") -> None:
        self.suffix = suffix
        self.vocab = vocab
        self.rank = {(vocab[a], vocab[b]): (i, vocab[a + b]) for i, (a, b) in enumerate(merges)}
        symbols: dict[int, tuple[str, ...]] = {}
        for text, i in vocab.items():
            closed = bool(suffix) and text.endswith(suffix) and len(text) > len(suffix)
            chars = list(text[: -len(suffix)] if closed else text)
            symbols[i] = tuple([*chars[:-1], chars[-1] + suffix] if closed else chars)
        self.symbols = symbols
        self.pairs: dict[tuple[int, int], bool] = {}
        # tokens by their symbols read backwards: a trie of endings
        self.endings: dict = {}
        for i, s in symbols.items():
            node = self.endings
            for c in reversed(s):
                node = node.setdefault(c, {})
            node[None] = (i, len(s))

    def merge(self, ids: list[int]) -> list[int]:
        """Plain merging: lowest rank first, leftmost first."""
        while len(ids) > 1:
            best = min(((self.rank[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.rank), default=None)
            if best is None:
                break
            k = best[1]
            ids = [*ids[:k], self.rank[ids[k], ids[k + 1]][1], *ids[k + 2 :]]
        return ids

    def stays(self, a: int, b: int) -> bool:
        """Whether merging the symbols of a and b together gives a, b again (a of -1: of b alone gives b)."""
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        tokens = [a, b] if a >= 0 else [b]
        ok = self.pairs[a, b] = self.merge([self.vocab[c] for t in tokens for c in self.symbols[t]]) == tokens
        return ok

    def encode(self, words: Iterable[str]) -> dict[str, list[int]]:
        """The ids of each distinct, non-empty word; words with a symbol outside the vocabulary are left out."""
        trie: dict = {}
        for w in words:
            node = trie
            for c in w[:-1]:
                below = node.get(c)
                if below is None:
                    below = node[c] = {}
                node = below
            node.setdefault(w[-1] + self.suffix, {})[None] = w
        out: dict[str, list[int]] = {}
        path: list[str] = []
        last: list[tuple[int, int]] = []  # (last token, symbols in it) of each prefix on the path
        stack = [iter(trie.items())]
        vocab, endings, stays = self.vocab, self.endings, self.stays
        known = self.pairs.get
        while stack:
            for symbol, below in stack[-1]:
                if symbol is None:
                    ids, k = [], len(last)
                    while k:
                        token, size = last[k - 1]
                        ids.append(token)
                        k -= size
                    ids.reverse()
                    out[below] = ids
                    continue
                if symbol not in vocab:
                    continue
                path.append(symbol)
                node, n, found = endings, len(path), []
                for c in reversed(path):
                    node = node.get(c)
                    if node is None:
                        break
                    ends = node.get(None)
                    if ends is not None:
                        found.append(ends)
                while found:
                    ends = found.pop()
                    token, size = ends
                    before = last[n - size - 1][0] if size < n else -1
                    ok = known((before, token))
                    if ok or ok is None and stays(before, token):
                        last.append(ends)
                        break
                else:
                    raise ValueError(f"no token ends {''.join(path)!r}")
                stack.append(iter(below.items()))
                break
            else:
                stack.pop()
                if path:
                    path.pop()
                    last.pop()
        return out


def _ascii_words(spec: dict) -> Callable[[str], list[str]] | None:
    """The file's own expression for words, for lower-case ASCII text without white space; None if the file cuts words in another way."""
    normal, cut = spec.get("normalizer") or {}, (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    kinds = [x["type"] for x in normal.get("normalizers", [])]
    if kinds != ["NFC", "Replace", "Lowercase"] or normal["normalizers"][1]["pattern"] != {"Regex": r"\s+"} or [x["type"] for x in cut] != ["Split", "ByteLevel"]:
        return None
    words, letters = cut
    pattern = words["pattern"].get("Regex", "(")
    if (words["behavior"], words["invert"]) != ("Removed", True) or letters["use_regex"] or letters["add_prefix_space"]:
        return None
    pattern = pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9").replace(r"\s", " ")
    return None if set(pattern) & set("\\({?.$") else re.compile(pattern).findall


class PieceEncoder:
    """Token ids of pieces of text without ASCII white space, for a word-level BPE file of the tokenizers library.

    The file's own normaliser and pre-tokenizer cut a piece into words; the trie encodes the words. Pieces that hold
    one of the file's added tokens, and words with symbols outside the vocabulary, are encoded by the library.
    """

    def __init__(self, path: str) -> None:
        self.tk = load_tokenizer(path)
        spec = json.loads(self.tk.to_str())
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.bpe = TrieBpe(spec["model"]["vocab"], merges, spec["model"].get("end_of_word_suffix") or "")
        self.words: dict[str, list[int]] = {}
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.names = {i: t for t, i in self.tk.get_vocab(with_added_tokens=True).items()}
        self.ascii_words = _ascii_words(spec)

    def encode(self, pieces: list[str]) -> list[list[int]]:
        cut: list[list[str] | None] = []
        for p in pieces:
            if p.isascii() and p.isalpha():  # one word, the same in the byte-level alphabet
                cut.append([p.lower()])
            elif "<|" in p and any(a in p for a in self.added):
                cut.append(None)
            elif self.ascii_words and p.isascii() and p.isprintable():  # the byte-level alphabet has these signs as they are
                cut.append(self.ascii_words(p.lower()))
            else:
                normal = self.tk.normalizer.normalize_str(p)
                cut.append([w for w, _ in self.tk.pre_tokenizer.pre_tokenize_str(normal)])
        if len(self.words) > CACHE:
            self.words.clear()
        ids = self.words
        new = self.bpe.encode(dict.fromkeys(w for ws in cut for w in ws or () if w not in ids))
        ids.update((w, i) for w, i in new.items() if len(w) <= CACHED_BYTES)
        out = []
        for p, ws in zip(pieces, cut, strict=True):
            if ws is None or None in (mine := [new[w] if w in new else ids.get(w) for w in ws]):
                out.append(self.tk.encode(p, add_special_tokens=False).ids)
            else:
                out.append(mine[0] if len(mine) == 1 else [i for x in mine for i in x])
        return out


@contextmanager
def _no_search_for_cycles():
    """Tries and remembered words are many objects without cycles: one run of the code before took 845 CPU seconds a GB without the search, 968 with it."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


_WORKER: dict[str, tuple[PieceEncoder, dict]] = {}


def _worker(path: str) -> tuple[PieceEncoder, dict]:
    """The worker's encoder and the pieces it remembers, for all its tasks."""
    if path not in _WORKER:
        _WORKER[path] = (PieceEncoder(path), {})
        give_back()  # reading the file takes several times what stays
    return _WORKER[path]


def _looked_up(words: list[bytes], cache: dict, encode) -> list:
    """What encode gives for each word; the cache remembers short ones."""
    found = [cache.get(w) for w in words]
    new = [k for k, x in enumerate(found) if x is None]
    if new:
        if len(cache) > CACHE:
            cache.clear()
        for k, x in zip(new, encode([words[k].decode("utf-8", "replace") for k in new]), strict=True):
            found[k] = x
            if len(words[k]) <= CACHED_BYTES:
                cache[words[k]] = x
    return found


def encode_batches(path: str):
    def digests(text: pa.Array) -> tuple[np.ndarray, list, list]:
        encoder, cache = _worker(path)
        names = encoder.names
        written = lambda pieces: [(len(ids), " ".join(map(str, ids)), " ".join([names[i] for i in ids])) for ids in encoder.encode(pieces)]
        data, off, _ = text_buffers(text)
        n = len(off) - 1
        counts = np.zeros(n, np.int64)
        sha_ids, sha_text = [hashlib.sha256() for _ in range(n)], [hashlib.sha256() for _ in range(n)]
        for s in slices(data, off):
            starts, ends, first = word_bounds(s)
            words, inverse = distinct_ranges(s.data, starts, ends)
            found = _looked_up(words, cache, written)
            sizes = np.array([x[0] for x in found], np.int64)
            as_ids, as_text = np.array([x[1] for x in found], object), np.array([x[2] for x in found], object)
            blank = not sizes.all() if len(sizes) else False
            for r, a, z in zip(s.rows.tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                if a == z:
                    continue
                mine = inverse[a:z]
                if blank:  # pieces that give no token
                    mine = mine[sizes[mine] > 0]
                    if not len(mine):
                        continue
                glue = " " if counts[r] else ""
                counts[r] += int(sizes[mine].sum())
                sha_ids[r].update((glue + " ".join(as_ids[mine].tolist())).encode())
                sha_text[r].update((glue + " ".join(as_text[mine].tolist())).encode())
        return counts, [h.hexdigest() for h in sha_ids], [h.hexdigest() for h in sha_text]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with _no_search_for_cycles():
                counts, ids, text = digests(batch.column(1))
            give_back()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def id_batches(path: str):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, cache = PieceEncoder(path), {}  # ids alone, so not the digests' cache
        for batch in batches:
            data, off, _ = text_buffers(batch.column(1))
            parts: list[list[np.ndarray]] = [[] for _ in range(len(off) - 1)]
            for s in slices(data, off):
                starts, ends, first = word_bounds(s)
                words, inverse = distinct_ranges(s.data, starts, ends)
                ids = _looked_up(words, cache, encoder.encode)
                for r, a, z in zip(s.rows.tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                    parts[r].append([i for k in inverse[a:z].tolist() for i in ids[k]])
            whole = [[i for p in row for i in p] for row in parts]
            text = [" ".join([encoder.names[i] for i in row]) for row in whole]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(whole, pa.list_(pa.int32())), pa.array(text, pa.string())], names=["doc_id", "ids", "decoded"])

    return run


def bpe_encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids and decoded text (the file has no decoder: token strings joined by one space) of every row.

    A null text gives no ids and an empty decoded text; null doc_ids, repeated rows and an empty table are kept as they
    are. Other columns are ignored. No shuffle.
    """
    small_batches(docs.sparkSession)
    return pick(docs, doc_id="long", text="string").mapInArrow(id_batches(tokenizer), "doc_id long, ids array<int>, decoded string")


def bpe_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and decoded text, by the same encoder; texts of any length stream through."""
    small_batches(docs.sparkSession)
    return pick(docs, doc_id="long", text="string").mapInArrow(encode_batches(tokenizer), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
