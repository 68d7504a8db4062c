"""Shared helpers: session settings, null-safe column selection, checked broadcasts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociq.storage import new_path, stored

__all__ = ["crc32_bucket", "give_back", "join_checked", "new_path", "pick", "picked", "released", "small_batches", "stored", "table"]

#: Rows in one Arrow batch handed to Python; texts may be long, so batches are kept short.
BATCH_ROWS = 512
#: Bytes after which an Arrow batch ends, however few rows it has.
BATCH_BYTES = 16 << 20
#: A table of at most so many rows may be broadcast; it is counted first.
BROADCAST_ROWS = 100_000


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the Arrow batch size, so that a batch of long texts stays small; never raises a smaller setting."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if _bytes(spark.conf.get(key, "64m")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def _bytes(setting: str) -> int:
    """Bytes of a setting such as 64m, 64MB or 1024."""
    number = setting.lower().removesuffix("b")
    unit = number[-1:]
    return int(number[:-1]) << 10 * (1 + "kmgtp".index(unit)) if unit and unit in "kmgtp" else int(number)


def give_back() -> None:
    """Give memory that this process has freed back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def released(task: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """The task's function, after which a worker gives the memory that it freed back to the machine: workers are kept for later tasks."""

    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch], *args, **named) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches, *args, **named)
        finally:
            give_back()

    return run


def pick(df: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast; columns that are missing become null, all others are left out."""
    return df.select(*picked(df, **types))


def picked(df: DataFrame, prefix: str = "", **types: str) -> list[Column]:
    """The columns of pick, their names after prefix."""
    have = {c.lower(): c for c in df.columns}
    return [(F.col(f"`{have[c]}`").cast(t) if c in have else F.lit(None).cast(t)).alias(prefix + c) for c, t in types.items()]


def join_checked(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a stored table; it is broadcast only if a count shows at most `rows` rows."""
    return left.join(F.broadcast(right) if right.count() <= rows else right, on, how)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc32_bucket(col: Column, n: int) -> Column:
    """crc32 of the value as text, modulo n; null for null."""
    return F.crc32(col.cast("string").cast("binary")) % n
