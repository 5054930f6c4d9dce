"""Paths on whatever file system the path names, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Codec of the warehouse's parquet files and of what is stored on the way to them; readers find it in the files.
COMPRESSION = "zstd"
#: How these files are written: keys, dates and stamps of neighbouring rows take less room as differences, which version 2 stores.
PARQUET = {"compression": COMPRESSION, "parquet.writer.version": "v2"}

_scope: ContextVar[list[str] | None] = ContextVar("batchloom_scratch", default=None)
_local_root: str | None = None


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _filesystem(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty when the folder is missing."""
    fs, p = _filesystem(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files in a folder; 0 when it is missing."""
    fs, p = _filesystem(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _filesystem(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> None:
    """Write one small file; unless ``replace`` is set, a file that is there already is an error."""
    fs, p = _filesystem(spark, path)
    out = fs.create(p, replace)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _filesystem(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


#: Written by this library after a Spark write has returned; clusters may switch Spark's own marker off.
_RECORD = "_committed"


class UncommittedError(RuntimeError):
    """Folders hold data, but no record says that any of it is complete."""


def commit(spark: SparkSession, path: str, text: str = "") -> None:
    """Record that the folder's write is complete, with what the writer knows of it."""
    write_text(spark, f"{path}/{_RECORD}", text, replace=True)


def commit_text(spark: SparkSession, path: str) -> str:
    """What the writer of a committed folder recorded."""
    return read_text(spark, f"{path}/{_RECORD}") if exists(spark, f"{path}/{_RECORD}") else ""


def committed(spark: SparkSession, path: str) -> bool:
    """True once the write into this folder was recorded as complete."""
    return exists(spark, f"{path}/{_RECORD}") or exists(spark, f"{path}/_SUCCESS")


def numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Sorted n of the committed sub-folders ``<prefix><n>``."""
    found = [int(n[len(prefix):]) for n in list_names(spark, path) if n.startswith(prefix)]
    done = sorted(n for n in found if committed(spark, f"{path}/{prefix}{n}"))
    # A write that failed leaves no files at the top of its folder; files without a record have lost it.
    if found and not done and any(f.startswith("part-") for n in found for f in list_names(spark, f"{path}/{prefix}{n}")):
        raise UncommittedError(f"{path} has data but no commit record: put an empty {_RECORD} into complete folders, drop the others")
    return done


def next_number(spark: SparkSession, path: str, prefix: str) -> int:
    """One above every sub-folder ``<prefix><n>``, committed or not."""
    return max((int(n[len(prefix):]) for n in list_names(spark, path) if n.startswith(prefix)), default=0) + 1


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; only a local session may fall back to a folder of its own."""
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="batchloom-")
    return _local_root


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/batchloom/{label}-{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    return path


def write_scratch(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write once and read back: later stages read stored rows, whatever executors are lost. The codec is the session's unless given."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    (df.write if compression is None else df.write.options(**{**PARQUET, "compression": compression})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, label: str, *key: str) -> DataFrame:
    """``write_scratch`` in buckets of a key, as many as shuffle partitions: grouping by it or joining on it moves no row again.

    Rows that a join on the key has brought together are written where they are. Spark takes bucketing from its catalog only, so
    the folder is declared there, as an external table, for as long as it takes to write and resolve it.
    """
    spark = df.sparkSession
    number, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"batchloom_{uuid.uuid4().hex}"
    writer = df.repartition(number, *key).write.bucketBy(number, *key).format("parquet").options(**PARQUET)
    try:
        writer.option("path", scratch_path(spark, label)).saveAsTable(name)
        return spark.table(name).select(*df.columns)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch folders made inside the block are dropped at its end."""
    made: list[str] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in made:
            delete(spark, path)
