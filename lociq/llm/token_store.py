"""Token ids in compressed shard files.

A shard file holds the documents of one range of doc_id, in ascending order:

    blank    as many zero bytes as the header has; frames begin behind them
    frames   one zstandard frame per document: its ids, little-endian, compressed with the shared dictionary
    index    doc_id (i64; 0 for a null), ids (u64), offset of the frame's end (u64) and null flag of doc_id (u8), as four arrays
    header   magic 'LQTOKEN1', width of an id in bytes (u32), documents (u64), SHA-256 of the dictionary (32 bytes)
    footer   offset of the index (u64), magic

The dictionary is trained on serialized id arrays of a bounded sample and stored beside the shards under its hash. It changes
only how small the frames are. A task writes its file under a name with the attempt's number, and only files named by
the manifest, which Spark commits, are part of a store: a lost executor or a second attempt leaves at most an unused file.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociq.llm.common import new_path, pick, small_batches
from lociq.llm.token_counts import CACHE, CACHED_BYTES, load_tokenizer
from lociq.llm.words import distinct_ranges, slices, text_buffers, word_bounds

MAGIC = b"LQTOKEN1"
_HEAD, _HEAD_SIZE = "<8sIQ32s", struct.calcsize("<8sIQ32s")
_FOOT, _FOOT_SIZE = "<Q8s", struct.calcsize("<Q8s")
#: Sample that the dictionary is trained on: so many documents (those with the smallest hash), so many bytes of each at most.
SAMPLE_DOCS = 400
SAMPLE_BYTES = 8 << 10
DICT_BYTES = 64 << 10
LEVEL = 3
_END = 0
_BLANK = b" \t\n\v\f\r"
#: White space beyond ASCII, in UTF-8: U+0085, U+00A0, U+1680, U+2000-200A, U+2028, U+2029, U+202F, U+205F, U+3000. (Fixed values.)
_WIDE_SPACE = rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"


class IdEncoder:
    """Ids of whole texts as bytes, for a byte-level BPE file whose pre-tokenizer puts a space before a word with it.

    Such a pre-tokenizer always cuts between a character other than white space and white space. So a text is cut there, every
    distinct piece (white space with the word behind it) is encoded once by the library, and the results are
    joined. Texts with white space beyond ASCII are encoded whole by the library.
    """

    def __init__(self, path: str) -> None:
        import re

        self.tk = load_tokenizer(path)
        self.type = np.dtype("<u2" if self.tk.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.wide = re.compile(_WIDE_SPACE)
        self.cache: dict[bytes, np.ndarray] = {}
        special = {t.content for t in self.tk.get_added_tokens_decoder().values()}
        self.sizes = np.zeros(self.tk.get_vocab_size(with_added_tokens=True), np.int64)  # bytes of each token; a symbol stands for a byte
        for token, i in self.tk.get_vocab(with_added_tokens=True).items():
            self.sizes[i] = len(token.encode()) if token in special else len(token)

    def library(self, texts: list[bytes]) -> list[np.ndarray]:
        encoded = self.tk.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(e.ids, self.type) for e in encoded]

    def pieces(self, texts: list[bytes]) -> list[np.ndarray]:
        """The same for pieces: those that begin with white space and end with another character are encoded joined, as nothing
        crosses their edges, and cut where their bytes end."""
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = [k for k, t in enumerate(texts) if t[0] in _BLANK and t[-1] not in _BLANK]
        for a in range(0, len(plain), 8192):
            mine = plain[a : a + 8192]
            ids = self.library([b"".join([texts[k] for k in mine])])[0]
            upto = np.cumsum(self.sizes[ids])
            ends = np.cumsum([len(texts[k]) for k in mine])
            cut = np.searchsorted(upto, ends)
            if len(ids) and upto[-1] == ends[-1] and (upto[cut] == ends).all():
                for k, x, z in zip(mine, [0, *(cut[:-1] + 1).tolist()], (cut + 1).tolist(), strict=True):
                    out[k] = ids[x:z]
        rest = [k for k, x in enumerate(out) if x is None]
        for k, x in zip(rest, self.library([texts[k] for k in rest]), strict=True):
            out[k] = x
        return out

    def encode(self, column: pa.Array) -> list[list[np.ndarray]]:
        """For each text, arrays of ids to be joined."""
        data, off, _ = text_buffers(column)
        out: list[list[np.ndarray]] = [[] for _ in range(len(off) - 1)]
        odd = np.zeros(len(out), bool)
        if len(data) and self.wide.search(data):
            for m in self.wide.finditer(data):
                odd[np.searchsorted(off, m.start(), "right") - 1] = True
            for r in np.flatnonzero(odd).tolist():
                out[r] = self.library([data[off[r] : off[r + 1]].tobytes()])
        for s in slices(data, off):
            _, ends, first = word_bounds(s)
            # a piece ends where its word ends; the last piece of a text may be white space only
            filled = np.diff(s.bounds) > 0
            tail = filled & ((np.diff(first) == 0) | (ends[np.maximum(first[1:] - 1, 0)] != s.bounds[1:] if len(ends) else True))
            stops = np.sort(np.concatenate((ends, s.bounds[1:][tail])))
            begins = np.concatenate(([0], stops[:-1])) if len(stops) else stops
            count = np.diff(first) + tail
            pieces, inverse = distinct_ranges(s.data, begins, stops)
            ids = [self.cache.get(p) for p in pieces]
            new = [k for k, x in enumerate(ids) if x is None]
            if len(self.cache) > CACHE:
                self.cache.clear()
            for k, x in zip(new, self.pieces([pieces[k] for k in new]), strict=True):
                ids[k] = x
                if len(pieces[k]) <= CACHED_BYTES:
                    self.cache[pieces[k]] = x.copy()
            if not ids:
                continue
            lens = np.array([len(x) for x in ids], np.int64)
            flat, heads = np.concatenate(ids), np.concatenate(([0], np.cumsum(lens)[:-1]))
            sizes = lens[inverse]
            upto = np.concatenate(([0], np.cumsum(sizes)))
            whole = flat[np.repeat(heads[inverse] - upto[:-1], sizes) + np.arange(upto[-1])]
            edge = upto[np.concatenate(([0], np.cumsum(count)))]
            for r, a, z in zip(s.rows.tolist(), edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                if z > a and not odd[r]:
                    out[r].append(whole[a:z])
        return out


_WORKER: dict[str, IdEncoder] = {}


def _encoder(path: str) -> IdEncoder:
    """The worker's encoder, with the pieces that its earlier tasks met."""
    if path not in _WORKER:
        _WORKER[path] = IdEncoder(path)
    return _WORKER[path]


def _filesystem(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def _shard_writer(tokenizer: str, uri: str, dictionary: bytes, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        context = TaskContext.get()
        shard, name = context.partitionId(), f"shard-{context.partitionId():06d}-{context.taskAttemptId()}.bin"
        encoder = _encoder(tokenizer)
        with_dict = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        compressor = zstandard.ZstdCompressor(level=level, **with_dict)
        fs, folder = _filesystem(uri)
        doc_ids, lens, ends, at, end_id = [], [], [], _HEAD_SIZE, np.array([_END], encoder.type)
        sink = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if sink is None:
                sink = fs.open_output_stream(f"{folder}/{name}")
                sink.write(b"\0" * _HEAD_SIZE)
            for doc_id, parts in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)), strict=True):
                ids = np.concatenate((*parts, end_id))
                frame = compressor.compress(ids.tobytes())
                sink.write(frame)
                at += len(frame)
                doc_ids.append(doc_id)
                lens.append(len(ids))
                ends.append(at)
        if sink is not None:
            nulls = [d is None for d in doc_ids]
            ids = np.array([0 if d is None else d for d in doc_ids], "<i8")
            sink.write(ids.tobytes() + np.array(lens, "<u8").tobytes() + np.array(ends, "<u8").tobytes() + np.array(nulls, "u1").tobytes())
            # streams cannot go back: the header's fields stand in the footer
            sink.write(struct.pack(_HEAD, MAGIC, encoder.type.itemsize, len(ids), hashlib.sha256(dictionary).digest()) + struct.pack(_FOOT, at, MAGIC))
            sink.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "file": [name], "docs": [len(ids)], "ids": [int(sum(lens))]}, schema=pa.schema([("shard", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]))

    return run


def read_index(source) -> tuple[np.dtype, bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(id type, dictionary hash, doc_ids, is-null flags, ids per document, frame bounds) of an open shard file."""
    size = source.size()
    source.seek(size - _FOOT_SIZE - _HEAD_SIZE)
    tail = source.read(_FOOT_SIZE + _HEAD_SIZE)
    magic, width, n, digest = struct.unpack(_HEAD, tail[: _HEAD_SIZE])
    at, magic2 = struct.unpack(_FOOT, tail[_HEAD_SIZE :])
    if magic != MAGIC or magic2 != MAGIC:
        raise ValueError("not a token shard")
    source.seek(at)
    raw = source.read(25 * n)
    doc_ids, lens, ends = (np.frombuffer(raw, t, n, 8 * n * k) for k, t in enumerate(("<i8", "<u8", "<u8")))
    return np.dtype(f"<u{width}"), digest, doc_ids, np.frombuffer(raw, "u1", n, 24 * n), lens, np.concatenate(([_HEAD_SIZE], ends)).astype(np.int64)


def read_document(uri: str, file: str, dictionary: bytes, k: int) -> np.ndarray:
    """The ids of document k of a shard, reading only its index and its frame."""
    import zstandard

    fs, folder = _filesystem(uri)
    with fs.open_input_file(f"{folder}/{file}") as source:
        kind, digest, _, _, _, bounds = read_index(source)
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("the shard was written with another dictionary")
        source.seek(int(bounds[k]))
        frame = source.read(int(bounds[k + 1] - bounds[k]))
    with_dict = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    return np.frombuffer(zstandard.ZstdDecompressor(**with_dict).decompress(frame), kind)


def _shard_reader(uri: str, dictionary: bytes, rows: int = 2048):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        with_dict = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        inflate = zstandard.ZstdDecompressor(**with_dict)
        fs, folder = _filesystem(uri)
        digest = hashlib.sha256(dictionary).digest()
        for batch in batches:
            for file, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with fs.open_input_file(f"{folder}/{file}") as source:
                    kind, found, doc_ids, nulls, lens, bounds = read_index(source)
                    if found != digest:
                        raise ValueError(f"{file} was written with another dictionary")
                    starts = before + np.concatenate(([0], np.cumsum(lens)[:-1])).astype(np.int64)
                    for a in range(0, len(doc_ids), rows):
                        z = min(len(doc_ids), a + rows)
                        source.seek(int(bounds[a]))
                        raw = source.read(int(bounds[z] - bounds[a]))
                        sums, counts = [], []
                        for k in range(a, z):
                            ids = np.frombuffer(inflate.decompress(raw[bounds[k] - bounds[a] : bounds[k + 1] - bounds[a]]), kind)
                            counts.append(len(ids))
                            sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                        yield pa.RecordBatch.from_arrays([pa.array(doc_ids[a:z], pa.int64(), mask=nulls[a:z].astype(bool)), pa.array(starts[a:z]), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())], schema=schema)

    return run


def _sample_ids(tokenizer: str, cap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            found = [np.concatenate(p).tobytes()[:cap] if p else b"" for p in encoder.encode(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["ids"])

    return run


def train_dictionary(docs: DataFrame, tokenizer: str, size: int = DICT_BYTES, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> bytes:
    """A zstandard dictionary from the id arrays of the sample; empty if there is too little to train on."""
    import zstandard

    place = F.xxhash64("doc_id")
    ids = [r[0] for r in docs.where("text IS NOT NULL").select("doc_id", place.alias("place")).orderBy("place").limit(sample_docs).select("doc_id").collect()]
    if not ids:
        return b""
    wanted = docs.where(F.col("doc_id").isin([i for i in ids if i is not None]) & F.col("text").isNotNull())
    sample = wanted.groupBy("doc_id").agg(F.min("text").alias("text")).orderBy("doc_id").select("text")  # one text for each id
    found = [bytes(r[0]) for r in sample.mapInArrow(_sample_ids(tokenizer, sample_bytes), "ids binary").collect()]
    try:
        return zstandard.train_dictionary(size, [x for x in found if len(x) >= 16]).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_store(docs: DataFrame, tokenizer: str, uri: str | None = None, level: int = LEVEL) -> tuple[str, bytes]:
    """Write docs' ids, in ascending doc_id order, an end id (0) after each; returns the store's folder and its dictionary.

    The manifest (Parquet, in the folder `manifest`) lists the shards with their counts. Null texts are empty (the end id only).
    Null doc_ids come first; repeated doc_ids stand side by side in order of their texts' hashes. Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    uri = uri or new_path(spark, "tokens")
    rows = pick(docs, doc_id="long", text="string")
    dictionary = train_dictionary(rows, tokenizer)
    fs, folder = _filesystem(uri)
    fs.create_dir(folder, recursive=True)
    with fs.open_output_stream(f"{folder}/dictionary-{hashlib.sha256(dictionary).hexdigest()}.zdict") as out:
        out.write(dictionary)
    # ranges of doc_id and the text's hash, so that a null or repeated doc_id is no single range
    ordered = rows.withColumn("hash", F.xxhash64("text")).repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text").select("doc_id", "text")
    ordered.mapInArrow(_shard_writer(tokenizer, uri, dictionary, level), "shard int, file string, docs long, ids long").write.parquet(f"{uri}/manifest")
    return uri, dictionary


def read_store(spark: SparkSession, uri: str, dictionary: bytes) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    manifest = spark.read.schema("shard int, file string, docs long, ids long").parquet(f"{uri}/manifest")
    upto = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0))  # a row for each shard file
    shards = manifest.select("file", (upto - F.col("ids")).alias("before"))
    n = max(1, manifest.count())
    return shards.repartition(min(n, 10_000), "file").mapInArrow(_shard_reader(uri, dictionary), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_store(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write docs' ids and read them back."""
    return read_store(docs.sparkSession, *write_store(docs, tokenizer))
