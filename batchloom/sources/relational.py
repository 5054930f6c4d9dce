"""Incremental extract from a relational source or any other table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def extract_since(df: DataFrame, columns: Sequence[str], ts_col: str, since: dt.date) -> DataFrame:
    """The listed columns of rows changed on or after ``since`` (inclusive).

    The comparison is with a plain literal, so JDBC and parquet sources filter at the scan.
    """
    return df.where(F.col(ts_col) >= F.lit(since).cast("timestamp")).select(*columns)


def day_slices(ts_col: str, since: dt.date, until: dt.date, days: int) -> list[str]:
    """Predicates that cut ``[since, ...)`` into slices of ``days`` for a parallel read; the last is open-ended."""
    if days < 1:
        raise ValueError("a slice covers at least one day")
    starts = [since]
    while starts[-1] + dt.timedelta(days=days) < until:
        starts.append(starts[-1] + dt.timedelta(days=days))
    edges = [f"{ts_col} >= DATE '{a}' AND {ts_col} < DATE '{b}'" for a, b in zip(starts, starts[1:])]
    return [*edges, f"{ts_col} >= DATE '{starts[-1]}'"]


#: Rows one connection may read.
ROWS_PER_SLICE = 5_000_000


def key_slices(column: str, bounds: tuple[int | None, int | None, int], rows: int = ROWS_PER_SLICE) -> list[str]:
    """Predicates that cut a table along a whole-number key into slices of about ``rows`` rows.

    ``bounds``: the key's least and largest value and the number of rows. The first and the last slice are open, so rows that
    come in meanwhile are read, too, and rows without a key are in the first. Slices are equally wide; keys far from evenly
    spread give uneven ones.
    """
    if rows < 1:
        raise ValueError("a slice has at least one row")
    least, most, count = bounds
    if least is None or most is None or count <= rows:
        return ["1 = 1"]
    n = min(-(-count // rows), most - least + 1)
    edges = [least + (most - least + 1) * i // n for i in range(1, n)]
    if not edges:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(edges, edges[1:])]
    return [f"({column} < {edges[0]} OR {column} IS NULL)", *inner, f"{column} >= {edges[-1]}"]


class UnslicedRead(ValueError):
    """A large remote table would be read over one connection."""


def read_relational(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    predicates: Sequence[str] | None = None,
    key: str | None = None,
    rows: int = ROWS_PER_SLICE,
) -> DataFrame:
    """A remote table (``schema.table``, ``table@link`` or a bracketed query) over JDBC.

    Each predicate becomes one parallel connection. Without predicates the source is asked how many rows there are, and with a
    whole-number ``key`` for its bounds, from which the slices are worked out. A table of more than ``rows`` rows without
    either is an error, since one task would read it. Connection details are call arguments and are never stored.
    """
    def fetch(query: str) -> tuple:
        return tuple(spark.read.jdbc(url, query, properties=properties).first())

    return spark.read.jdbc(url, table, predicates=slices_of(fetch, table, predicates, key, rows), properties=properties)


def slices_of(
    fetch: Callable[[str], tuple], table: str, predicates: Sequence[str] | None, key: str | None, rows: int = ROWS_PER_SLICE
) -> list[str]:
    """The predicates of a parallel read; ``fetch`` gives the one row of a query at the source."""
    if predicates:
        return list(predicates)
    if key is not None:
        least, most, count = fetch(f"(SELECT MIN({key}) AS a, MAX({key}) AS b, COUNT(*) AS n FROM {table}) bounds")
        return key_slices(key, (least if least is None else int(least), most if most is None else int(most), int(count)), rows)
    [count] = fetch(f"(SELECT COUNT(*) AS n FROM {table}) bounds")
    if count > rows:
        raise UnslicedRead(f"{table} has {count} rows: name a key or give predicates")
    return ["1 = 1"]
