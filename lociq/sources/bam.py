"""Binary alignment files (BGZF-compressed BAM with a linear index) as a Spark data source, for reading and writing.

    register_bam(spark)
    spark.read.format("bam").load(path)                                   # a file or a folder of files
    spark.read.format("bam").options(reference="chr1", start=0, end=900).load(path)
    write_bam(alignments, path, [("chr1", 5_000_000), ...])               # a sorted file with its index from each task

Files with an index (`x.bam.bai`) are cut where the index knows that a record begins; a file without one is a single part. A region reads from
the first block that its window of the linear index names to the first record behind its end.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

SCHEMA = "query_name string, flag int, reference_name string, ref_start bigint, mapq int, cigar string, seq string, qual string, ref_end bigint, is_reverse boolean"
#: Fixed values of the format.
OPERATIONS, BASES = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"
ON_REFERENCE = frozenset("MDN=X")
END_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
WINDOW_BITS, BLOCK_BYTES = 14, 0xFF00
#: Ends of what the bins and what positions can tell.
BINNED, POSITIONS = 1 << 29, (1 << 31) - 1
#: Compressed bytes of a part at least, rows of a batch, and the file offset that is behind every other.
SPLIT_BYTES, BATCH_ROWS, EVERYTHING = 32 << 20, 4096, (1 << 63) - 1
#: Operations up to which a record's own are remembered.
SHORT_CIGAR = 64

#: Between hexadecimal digits and letters; what is no letter of the format is N (15, as -1 is in four bits).
_LETTERS = str.maketrans("0123456789abcdef", BASES)
_DIGITS = "".join(f"{BASES.find(chr(b).upper()) & 15:x}" for b in range(256)).encode()
_PLUS_33 = bytes(min(b + 33, 255) for b in range(256))
_MINUS_33 = bytes(max(b - 33, 0) for b in range(256))


def located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


class Blocks:
    """The decompressed bytes of a file from a virtual offset on (compressed offset of a block, 16 bits of place in it)."""

    def __init__(self, source, offset: int = 0) -> None:
        self.source, self.size, self.read = source, source.size(), 0  # read: blocks so far
        self.next, self.data, self.at, self.block = offset >> 16, b"", 0, offset >> 16
        if self._load():
            self.at = offset & 0xFFFF

    def _load(self) -> bool:
        while self.next < self.size:
            head = self.source.read_at(18, self.next)
            if head[:4] != b"\x1f\x8b\x08\x04" or head[12:14] != b"BC":
                raise ValueError(f"no BGZF block at {self.next}")
            length = struct.unpack_from("<H", head, 16)[0] + 1
            extra = struct.unpack_from("<H", head, 10)[0]
            raw = self.source.read_at(length, self.next)
            self.block, self.next, self.at, self.read = self.next, self.next + length, 0, self.read + 1
            self.data = zlib.decompress(raw[12 + extra : -8], wbits=-15)
            if self.data:
                return True
        self.data, self.at, self.block = b"", 0, self.next
        return False

    def tell(self) -> int:
        if self.at >= len(self.data):
            self._load()
        return self.block << 16 | self.at

    def take(self, n: int) -> bytes:
        if self.at + n <= len(self.data):  # most records lie within a block
            self.at += n
            return self.data[self.at - n : self.at]
        parts = []
        while n:
            if self.at >= len(self.data) and not self._load():
                raise EOFError("the file ends within a record")
            part = self.data[self.at : self.at + n]
            self.at, n = self.at + len(part), n - len(part)
            parts.append(part)
        return b"".join(parts)


def read_header(blocks: Blocks) -> list[tuple[str, int]]:
    """Names and lengths of the references; blocks stand at the first record afterwards."""
    if blocks.take(4) != b"BAM\x01":
        raise ValueError("not a BAM file")
    blocks.take(struct.unpack("<i", blocks.take(4))[0])
    found = []
    for _ in range(struct.unpack("<i", blocks.take(4))[0]):
        name = blocks.take(struct.unpack("<i", blocks.take(4))[0])[:-1].decode()
        found.append((name, struct.unpack("<i", blocks.take(4))[0]))
    return found


def read_linear_index(raw: bytes) -> list[list[int]]:
    """For each reference the offsets of the first alignments that overlap its windows; 0 where there is none."""
    if raw[:4] != b"BAI\x01":
        raise ValueError("not an index")
    at, out = 8, []
    for _ in range(struct.unpack_from("<i", raw, 4)[0]):
        bins = struct.unpack_from("<i", raw, at)[0]
        at += 4
        for _ in range(bins):
            at += 8 + 16 * struct.unpack_from("<i", raw, at + 4)[0]
        n = struct.unpack_from("<i", raw, at)[0]
        out.append(list(struct.unpack_from(f"<{n}Q", raw, at + 4)))
        at += 4 + 8 * n
    return out


def _operations(raw: bytes, n: int) -> list[tuple[int, str]]:
    return [(c >> 4, OPERATIONS[c & 15]) for c in struct.unpack_from(f"<{n}I", raw)]


def _text(ops: list[tuple[int, str]]) -> tuple[str, int]:
    """Operations as text, and the letters of the reference that they take."""
    return "".join(f"{n}{o}" for n, o in ops) or "*", sum(n for n, o in ops if o in ON_REFERENCE)


@lru_cache(1 << 14)
def _cigar(raw: bytes) -> tuple[str, int]:
    return _text(_operations(raw, len(raw) // 4))


@lru_cache(1 << 14)
def _packed(cigar: str | None) -> tuple[bytes, int]:
    """Operations as bytes, and the letters of the reference that they take."""
    ops, n = [], 0
    for c in "" if cigar in (None, "*") else cigar:
        if c.isdigit():
            n = n * 10 + int(c)
        else:
            ops.append((n, c))
            n = 0
    return b"".join(struct.pack("<I", n << 4 | OPERATIONS.index(o)) for n, o in ops), sum(n for n, o in ops if o in ON_REFERENCE)


def _long_cigar(tags: bytes) -> list[tuple[int, str]] | None:
    """The CG tag, where operations go that do not fit a record's own field."""
    at, width = 0, {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
    while at + 3 <= len(tags):
        tag, kind = tags[at : at + 2], chr(tags[at + 2])
        at += 3
        if kind in "ZH":
            at = tags.index(0, at) + 1
        elif kind == "B":
            n = struct.unpack_from("<i", tags, at + 1)[0]
            if tag == b"CG":
                return _operations(tags[at + 5 :], n)
            at += 5 + n * width[chr(tags[at])]
        else:
            at += width[kind]
    return None


def read_records(blocks: Blocks, references: list[str], stop: int = EVERYTHING) -> Iterator[tuple]:
    """Rows of SCHEMA from where blocks stand to the offset stop."""
    while blocks.tell() < stop and blocks.data:
        raw = blocks.take(struct.unpack("<i", blocks.take(4))[0])
        ref, pos, n_name, mapq, _, n_cigar, flag, n_seq, _, _, _ = struct.unpack_from("<iiBBHHHiiii", raw)
        name = raw[32 : 31 + n_name].decode()
        a = 32 + n_name
        s = a + 4 * n_cigar
        q = s + (n_seq + 1) // 2
        cigar, length = _cigar(raw[a:s]) if n_cigar <= SHORT_CIGAR else _text(_operations(raw[a:], n_cigar))
        if n_cigar == 2 and cigar.startswith(f"{n_seq}S") and cigar[-1] == "N" and (ops := _long_cigar(raw[q + n_seq :])):
            cigar, length = _text(ops)
        seq = raw[s:q].hex().translate(_LETTERS)[:n_seq]
        quality = raw[q : q + n_seq]
        qual = "*" if not n_seq or quality[0] == 0xFF else quality.translate(_PLUS_33).decode("latin-1")
        yield (name, flag, references[ref] if ref >= 0 else "*", pos, mapq, cigar, seq or "*", qual, pos + length, bool(flag & 16))


@dataclass
class Part(InputPartition):
    path: str
    first: int
    stop: int
    indexed: bool  # so it is sorted, and a region's part begins at an alignment that its windows know


class BamReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.region = (options["reference"], int(options.get("start", 0)), int(options.get("end", EVERYTHING))) if "reference" in options else None
        self.blocks_read = 0

    def partitions(self) -> list[Part]:
        system, path = located(self.path)
        info = system.get_file_info(path)
        files = [path] if info.type == fs.FileType.File else sorted(f.path for f in system.get_file_info(fs.FileSelector(path)) if f.path.endswith(".bam"))
        return [p for f in files for p in self._parts(system, f)]

    def _parts(self, system: fs.FileSystem, path: str) -> list[Part]:
        with system.open_input_file(path) as source:
            blocks = Blocks(source)
            names = [n for n, _ in read_header(blocks)]
            first = blocks.tell()
        if system.get_file_info(f"{path}.bai").type != fs.FileType.File:
            return [Part(path, first, EVERYTHING, False)]
        with system.open_input_file(f"{path}.bai") as source:
            index = read_linear_index(source.read())
        if self.region:
            reference, start, end = self.region
            if reference not in names:
                return []
            windows = index[names.index(reference)][start >> WINDOW_BITS : max(end - 1, 0) + 1 + (1 << WINDOW_BITS) >> WINDOW_BITS]
            return [Part(path, min(known), EVERYTHING, True)] if (known := [w for w in windows if w]) else []
        cuts = [first]
        for offset in sorted({w for windows in index for w in windows if w}):
            if (offset >> 16) - (cuts[-1] >> 16) >= self.split:
                cuts.append(offset)
        return [Part(path, a, z, True) for a, z in zip(cuts, [*cuts[1:], EVERYTHING], strict=True)]

    def read(self, part: Part | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # Spark asks so if there are no parts
            return
        schema = pa.schema([("query_name", pa.string()), ("flag", pa.int32()), ("reference_name", pa.string()), ("ref_start", pa.int64()), ("mapq", pa.int32()), ("cigar", pa.string()), ("seq", pa.string()), ("qual", pa.string()), ("ref_end", pa.int64()), ("is_reverse", pa.bool_())])
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
        system, _ = located(self.path)
        with system.open_input_file(part.path) as source:
            names = [n for n, _ in read_header(Blocks(source))]
            blocks, rows = Blocks(source, part.first), []
            for row in read_records(blocks, names, part.stop):
                if self.region:
                    reference, start, end = self.region
                    if row[2] != reference or row[3] >= end:
                        if part.indexed:
                            break
                        continue
                    if row[1] & 4 or row[8] <= start:
                        continue
                rows.append(row)
                if len(rows) >= BATCH_ROWS:
                    yield batch(rows)
                    rows = []
            self.blocks_read += blocks.read
            if rows:
                yield batch(rows)


# writing


def bin_of(start: int, end: int) -> int:
    """Number of the smallest bin of the format's five levels that holds [start, end); the whole, 0, for what ends behind the last bin."""
    if end > BINNED:
        return 0
    for level, shift in enumerate((14, 17, 20, 23, 26)):
        if start >> shift == (end - 1) >> shift:
            return ((1 << 3 * (5 - level)) - 1) // 7 + (start >> shift)
    return 0


class BamFile:
    """Encodes sorted records to blocks and keeps what the index needs."""

    def __init__(self, sink, references: list[tuple[str, int]]) -> None:
        self.sink, self.done, self.buffer = sink, 0, bytearray()
        self.number = {n: k for k, (n, _) in enumerate(references)}
        self.bins: list[dict[int, list[list[int]]]] = [{} for _ in references]
        self.linear: list[list[int]] = [[] for _ in references]
        text = "@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{n}\tLN:{size}\n" for n, size in references)
        head = b"BAM\x01" + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", len(references))
        for n, size in references:
            head += struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", size)
        self._put(head)

    def _flush(self, n: int) -> None:
        data, self.buffer = bytes(self.buffer[:n]), self.buffer[n:]
        z = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = z.compress(data) + z.flush()
        block = struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))
        self.sink.write(block)
        self.done += len(block)

    def _put(self, data: bytes) -> None:
        if self.buffer and len(self.buffer) + len(data) > BLOCK_BYTES:
            self._flush(len(self.buffer))
        self.buffer += data
        while len(self.buffer) >= BLOCK_BYTES:
            self._flush(BLOCK_BYTES)

    def add(self, query_name: str, flag: int, reference_name: str, ref_start: int, mapq: int, cigar: str, seq: str, qual: str) -> None:
        packed, length = (_packed if len(cigar or "") <= 4 * SHORT_CIGAR else _packed.__wrapped__)(cigar)
        seq = "" if seq in (None, "*") else seq
        ref, pos = self.number.get(reference_name, -1), ref_start if ref_start is not None else -1
        end = pos + (length or 1)
        if end > POSITIONS:
            raise ValueError(f"{query_name}: {reference_name}:{end} is behind the last position of the format; cut the reference into pieces")
        tags, count = b"", len(packed) // 4
        if count > 0xFFFF:
            tags = b"CGBI" + struct.pack("<i", count) + packed
            packed, count = struct.pack("<II", len(seq) << 4 | 4, end - pos << 4 | 3), 2
        letters = seq.encode("latin-1", "replace").translate(_DIGITS).decode() + "0" * (len(seq) % 2)
        quality = b"\xff" * len(seq) if qual in (None, "*") else qual.encode("latin-1")
        if qual not in (None, "*", ""):
            if min(quality) < 33:
                raise ValueError(f"{query_name}: a quality below '!'")
            quality = quality.translate(_MINUS_33)
        name = query_name.encode()
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, mapq, bin_of(max(pos, 0), max(end, 1)), count, flag, len(seq), -1, -1, 0)
        body += name + b"\0" + packed + bytes.fromhex(letters) + quality + tags
        if len(self.buffer) + len(body) + 4 > BLOCK_BYTES and self.buffer:
            self._flush(len(self.buffer))
        at = self.done << 16 | len(self.buffer)
        self._put(struct.pack("<i", len(body)) + body)
        if ref >= 0 and pos >= 0:
            chunks = self.bins[ref].setdefault(bin_of(pos, end), [])
            after = self.done << 16 | len(self.buffer)
            if chunks and chunks[-1][1] == at:
                chunks[-1][1] = after
            else:
                chunks.append([at, after])
            windows = self.linear[ref]
            windows += [0] * ((end - 1 >> WINDOW_BITS) + 1 - len(windows))
            for w in range(pos >> WINDOW_BITS, (end - 1 >> WINDOW_BITS) + 1):
                windows[w] = windows[w] or at

    def close(self) -> bytes:
        """Ends the file; the bytes of its index."""
        if self.buffer:
            self._flush(len(self.buffer))
        self.sink.write(END_BLOCK)
        out = b"BAI\x01" + struct.pack("<i", len(self.bins))
        for bins, windows in zip(self.bins, self.linear, strict=True):
            out += struct.pack("<i", len(bins))
            for number, chunks in sorted(bins.items()):
                out += struct.pack("<Ii", number, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks)
            out += struct.pack(f"<i{len(windows)}Q", len(windows), *windows)
        return out


@dataclass
class Written(WriterCommitMessage):
    name: str | None


class BamWriter(DataSourceArrowWriter):
    """Each task writes a file under a name of its own attempt in `_attempts`; the commit moves those of the tasks that count."""

    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.references = options["path"], [tuple(r) for r in json.loads(options["references"])]
        self.overwrite = overwrite

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        task = TaskContext.get()
        system, path = located(self.path)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        system.create_dir(f"{path}/_attempts", recursive=True)
        with system.open_output_stream(f"{path}/_attempts/{name}.bam", compression=None) as sink:
            file = BamFile(sink, self.references)
            n = 0
            for batch in batches:
                for row in zip(*(batch.column(c).to_pylist() for c in ("query_name", "flag", "reference_name", "ref_start", "mapq", "cigar", "seq", "qual")), strict=True):
                    file.add(*row)
                n += batch.num_rows
            index = file.close()
        with system.open_output_stream(f"{path}/_attempts/{name}.bam.bai", compression=None) as sink:
            sink.write(index)
        return Written(name if n else None)

    def commit(self, messages: list) -> None:
        system, path = located(self.path)
        if self.overwrite:
            for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                if f.type == fs.FileType.File and f.path.endswith((".bam", ".bai")):
                    system.delete_file(f.path)
        for m in messages:
            if m is not None and m.name:
                for end in (".bam.bai", ".bam"):  # the index first, so that no file is seen without it
                    system.move(f"{path}/_attempts/{m.name}{end}", f"{path}/{m.name}{end}")
        self.abort(messages)

    def abort(self, messages: list) -> None:
        system, path = located(self.path)
        if system.get_file_info(f"{path}/_attempts").type == fs.FileType.Directory:
            system.delete_dir(f"{path}/_attempts")


class BamDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BamReader:
        return BamReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> BamWriter:
        return BamWriter(dict(self.options), overwrite)


def register_bam(spark: SparkSession) -> None:
    spark.dataSource.register(BamDataSource)


def write_bam(alignments: DataFrame, path: str, references: list[tuple[str, int]]) -> None:
    """Alignments (schemas.ALIGNMENTS) as sorted BAM files with indices, one of each range of reference and start; unplaced ones come last.

    References are in the given order; an alignment to another one counts as unplaced.
    """
    register_bam(alignments.sparkSession)
    place = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(n) for n, _ in references]), F.col("reference_name")), F.lit(0)), F.lit(len(references) + 1))
    rows = alignments.withColumn("place_", place).repartitionByRange("place_", "ref_start").sortWithinPartitions("place_", "ref_start", "query_name").drop("place_")
    rows.write.format("bam").mode("overwrite").option("references", json.dumps(references)).save(path)


def read_bam(spark: SparkSession, path: str, reference: str | None = None, start: int = 0, end: int | None = None) -> DataFrame:
    """Alignments of BAM files, as read_sam has them: all, or the mapped ones that overlap [start, end) of a reference."""
    register_bam(spark)
    reader = spark.read.format("bam")
    if reference is not None:
        reader = reader.options(reference=reference, start=start, **({} if end is None else {"end": end}))
    return reader.load(path)
