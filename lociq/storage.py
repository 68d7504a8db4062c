"""Shared intermediate storage for operators that run in rounds."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own if it is unset in local mode (tests).

    On a cluster a folder of one machine would lose rows in silence, so there the setting is required.
    """
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="lociq-shared-")
        where = _own[app]
    return where.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/lociq/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    if _open:
        _open[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_open: list[list[str]] = []


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession, *keep: str):
    """Tables that `stored` writes meanwhile are deleted at the end, but for those under the names in keep: what comes out must read no others."""
    _open.append([])
    try:
        yield
    finally:
        mine = _open.pop()
        kept = [p for p in mine if p.rsplit("/", 1)[1].rsplit("-", 1)[0] in keep]
        if _open:
            _open[-1] += kept
        for path in set(mine) - set(kept):
            _delete(spark, path)


class Rounds:
    """Tables of a loop by name: a round's table is deleted once its successor has been written, so that one of each name stays.

    What reads a superseded table must have been written or collected before its successor comes.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def next(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, name)
        df.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for path in [self.paths.pop(n) for n in names if n in self.paths]:
            _delete(self.spark, path)
