"""Dated CSV landing area: one folder per table, batch date and attempt."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchloom.sources.files import commit, next_number, numbered

# CSV dialect. Quotes are doubled inside quoted fields, NULL and
# the empty text are both an empty field, which loads as NULL.
_DIALECT = {
    "header": True,
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
_READ_DATE_FORMAT = "yyyy-MM-dd[ HH:mm:ss]"
_BYTES_PER_FILE = 64 << 20
_FILE = "file"


class LandingMissing(FileNotFoundError):
    """No committed attempt for this table and batch date."""


def landing_folder(root: str, table: str, batch_date: dt.date) -> str:
    return f"{root}/{table}/{batch_date}"


def _csv_bytes(df: DataFrame) -> Column:
    """At least the bytes a row takes in a file, but for what date and number formats add."""
    def width(field: T.StructField) -> Column:
        text = F.col(field.name).cast("string")
        quoted = F.octet_length(F.replace(text, F.lit('"'), F.lit('""'))) + 2 if isinstance(field.dataType, T.StringType) else F.octet_length(text)
        return F.coalesce(quoted, F.lit(0)).cast("bigint") + 1

    widths = [width(f) for f in df.schema.fields]
    return sum(widths[1:], widths[0])


def cut_by_bytes(df: DataFrame, limit: int) -> DataFrame:
    """The rows with ``file``, which changes whenever the bytes of a task's rows pass another multiple of the limit.

    The bytes are summed up along each task's rows, so a file has at most the limit and one row. Rows that come from
    different tasks never share a file.
    """
    @F.pandas_udf("bigint")
    def passed(sizes: Iterator[pd.Series]) -> Iterator[pd.Series]:
        before = 0
        for size in sizes:  # the batches of one task, in order
            upto = size.cumsum() + before
            yield (upto - size) // limit
            before = int(upto.iloc[-1]) if len(size) else before

    # Only the size of a row goes through the function, and nothing is shuffled.
    number = passed.asNondeterministic()(_csv_bytes(df))
    return df.withColumn(_FILE, F.format_string("%d-%d", F.spark_partition_id(), number))


def write_landing(
    df: DataFrame, root: str, table: str, batch_date: dt.date, limit: int = _BYTES_PER_FILE, compression: str = "none"
) -> str:
    """Write a new attempt; earlier attempts of the same batch are never overwritten.

    Quoted newlines make a CSV file one task on reading, so files have about ``limit`` bytes at most, however wide the rows are.
    The limit is one of text: files of a ``compression`` are smaller. They are read like the others, by their names.
    """
    folder = landing_folder(root, table, batch_date)
    path = f"{folder}/attempt={next_number(df.sparkSession, folder, 'attempt=')}"
    cut_by_bytes(df, limit).write.partitionBy(_FILE).options(**_DIALECT, dateFormat="yyyy-MM-dd", compression=compression).csv(path)
    commit(df.sparkSession, path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read landing CSV by declared schema. A header that differs from it, or a bad value, is an error."""
    return (
        spark.read.schema(schema)
        .options(**_DIALECT, dateFormat=_READ_DATE_FORMAT, multiLine=True, enforceSchema=False, mode="FAILFAST")
        .option("recursiveFileLookup", True)  # the folders of files are no columns
        .csv(path)
    )


def read_landing(
    spark: SparkSession, root: str, table: str, batch_date: dt.date, schema: T.StructType, attempt: str = "newest"
) -> DataFrame:
    """The newest (or ``first``) committed attempt of a batch."""
    folder = landing_folder(root, table, batch_date)
    attempts = numbered(spark, folder, "attempt=")
    if not attempts:
        raise LandingMissing(f"no landed {table} for {batch_date}")
    if attempt not in ("newest", "first"):
        raise ValueError("attempt is 'newest' or 'first'")
    return read_csv(spark, f"{folder}/attempt={attempts[0] if attempt == 'first' else attempts[-1]}", schema)
