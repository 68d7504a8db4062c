"""Token counts by overlap resynchronisation.

A text of more than `huge_bytes` is encoded in overlapping chunks with offsets. Two neighbouring chunks are spliced at a stable
boundary: a position in their overlap where both encodings have a token edge and where the pre-tokenizer cuts whatever stands
further away (behind a word before ASCII white space, behind a letter before a character that is neither letter nor mark, behind a
digit before no mark). If the overlap holds no such position it is doubled, and where it has grown to the whole chunk, the
chunk is at least doubled; so the work stays in proportion to the text whatever it holds.

Shorter texts fit into one chunk. They are cut at ASCII white space, which is such a boundary too, and each distinct piece is encoded once.
"""

from __future__ import annotations

import os
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociq.llm.common import pick, small_batches
from lociq.llm.words import distinct_ranges, slices, text_buffers, word_bounds

#: A text of more bytes is encoded in overlapping chunks.
HUGE_BYTES = 4 << 10
CHUNK_CHARS = 4 << 10
#: More than the longest special token has, so that no overlap lies inside one.
OVERLAP_CHARS = 128
#: Distinct pieces that a worker remembers (then it starts anew), and their length in bytes; longer ones are encoded each time.
CACHE, CACHED_BYTES = 400_000, 64
_WHITE = " \t\n\v\f\r"


def load_tokenizer(path: str):
    """The library's tokenizer, single-threaded (Spark runs one task per core), without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(path)
    tk.no_truncation()
    tk.no_padding()
    return tk


@lru_cache(65536)
def _kind(c: str) -> str:
    """L or N for a character that stays a letter or digit at its end when it is normalised and lowered, M for a mark, else O.

    By the oldest Unicode data at hand: what was a letter then is one in every library.
    """
    last = unicodedata.normalize("NFC", c).lower()[-1:]
    kinds = {unicodedata.ucd_3_2_0.category(c)[0], unicodedata.ucd_3_2_0.category(last)[0], unicodedata.category(c)[0], unicodedata.category(last)[0]}
    if len(kinds) > 1 or "C" in kinds:
        return "M"  # not the same everywhere: no boundary beside it
    return kinds.pop() if kinds & {"L", "N", "M"} else "O"


def stable(text: str, x: int) -> bool:
    """Whether the pre-tokenizer cuts between text[x - 1] and text[x] whatever else the text holds."""
    before, after = text[x - 1], text[x]
    if after in _WHITE:
        return before not in _WHITE
    one, two = _kind(before), _kind(after)
    return (one == "L" and two in "NO") or (one == "N" and two in "LNO")


def splice_count(encode_offsets, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Number of tokens of text; encode_offsets(part) gives the (start, end) of each token of a part."""
    n = len(text)
    total, left = 0, 0  # tokens before `left` are counted
    end = min(n, chunk)
    ends = [z for _, z in encode_offsets(text[:end])]
    while end < n:
        width = overlap
        while True:
            last = next((x for x in reversed(ends) if left < x < end and stable(text, x)), None)
            lo = left if last is None else max(left, last - width)  # without a stable place at all no overlap helps
            stop = min(n, end + max(chunk, end - lo))  # as much behind the overlap as in it, at least
            after = encode_offsets(text[lo:stop])
            ends2 = [z + lo for _, z in after]
            cut = _common(text, ends, after[0][0] + lo if after else end, ends2, lo, end)
            if cut is not None:
                total += bisect_right(ends, cut) - bisect_right(ends, left)
                left, end, ends = cut, stop, ends2
                break
            if lo == left:  # the chunk has more than doubled
                end, ends = stop, ends2
                break
            width *= 4
    return total + len(ends) - bisect_right(ends, left) if left else total + len(ends)


def _common(text: str, ends1: list[int], begun: int, ends2: list[int], lo: int, hi: int) -> int | None:
    """The last stable position in (lo, hi), behind the first token of the second chunk, where both encodings have a token edge."""
    edges2 = set(ends2)
    for k in range(len(ends1) - 1, bisect_right(ends1, max(lo, begun)) - 1, -1):
        x = ends1[k]
        if x < hi and x in edges2 and stable(text, x):
            return x
    return None


_WORKER: dict[str, tuple] = {}


def count_batches(path: str, huge: int, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _WORKER:  # later tasks of the worker find its pieces
            _WORKER[path] = (load_tokenizer(path), {})
        tk, cache = _WORKER[path]
        offsets_of = lambda part: tk.encode(part, add_special_tokens=False).offsets
        for batch in batches:
            data, off, _ = text_buffers(batch.column(1))
            size = np.diff(off)
            counts = np.zeros(len(size), np.int64)
            long_rows = np.flatnonzero(size > huge)
            for s in slices(data, off):
                starts, ends, first = word_bounds(s)
                usual = size[s.rows] <= huge
                if not usual.all():
                    keep = np.repeat(usual, np.diff(first))
                    starts, ends = starts[keep], ends[keep]
                    first = np.concatenate(([0], np.cumsum(np.where(usual, np.diff(first), 0))))
                words, inverse = distinct_ranges(s.data, starts, ends)
                found = [cache.get(w) for w in words]
                new = [k for k, n in enumerate(found) if n is None]
                if new:
                    if len(cache) > CACHE:
                        cache.clear()
                    encoded = tk.encode_batch_fast([words[k].decode("utf-8", "replace") for k in new], add_special_tokens=False)
                    for k, e in zip(new, encoded, strict=True):
                        found[k] = len(e)
                        if len(words[k]) <= CACHED_BYTES:
                            cache[words[k]] = len(e)
                per_word = np.array(found, np.int64)[inverse] if words else np.empty(0, np.int64)
                sums = np.concatenate(([0], np.cumsum(per_word)))
                counts[s.rows] += sums[first[1:]] - sums[first[:-1]]
            for r in long_rows.tolist():
                counts[r] = splice_count(offsets_of, data[off[r] : off[r + 1]].tobytes().decode("utf-8", "replace"), chunk, overlap)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048, huge_bytes: int = HUGE_BYTES, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of docs.

    A null text counts as empty: 0 bytes, 0 tokens. A null doc_id stays null; repeated rows are
    counted each. An empty table gives an empty result. Other columns are ignored. No shuffle.
    The tokenizer must cut at white space without keeping it, put letters into runs and digits alone (word_bpe_49k.json).
    """
    small_batches(docs.sparkSession)
    rows = pick(docs, doc_id="long", text="string")
    out = rows.mapInArrow(count_batches(tokenizer, huge_bytes, chunk_chars, overlap_chars), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
