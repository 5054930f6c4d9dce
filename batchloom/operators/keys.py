"""Dense, ordered surrogate keys without a single-task window."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchloom.operators.lookup import measured
from batchloom.sources.files import COMPRESSION, write_scratch

_PART, _POS, _BASE, _SIZE = "__part", "__pos", "__base", "__size"
# Fixed value: monotonically_increasing_id() keeps the row position in its low 33 bits.
_POSITION_MASK = (1 << 33) - 1


def max_id(table: DataFrame, id_col: str) -> int:
    """Highest key in the table, 0 when it is empty."""
    return table.agg(F.max(id_col)).first()[0] or 0


def assign_keys(rows: DataFrame, natural_key: Sequence[str], id_col: str, start: int = 0) -> DataFrame:
    """Rows numbered ``start + 1 ...`` in natural-key order; see ``assign_keys_from``."""
    return assign_keys_from(rows, natural_key, id_col, start)[0]


def assign_keys_from(rows: DataFrame, natural_key: Sequence[str], id_col: str, start: int) -> tuple[DataFrame, int]:
    """Number rows ``start + 1 ...`` in natural-key order; the rows and the last number given.

    One range shuffle sorts the rows into ordered partitions and stores them with their
    position. Only the partition sizes (one row per partition) reach the driver; their
    running sum is the base of each partition. The stored positions make the numbering
    safe against recomputation. ``natural_key`` must be unique in ``rows``.
    """
    ordered = (
        rows.repartitionByRange(*natural_key)
        .sortWithinPartitions(*natural_key)
        .withColumns(
            {
                _PART: F.spark_partition_id(),
                _POS: F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK)),
            }
        )
    )
    stored = write_scratch(ordered, "numbered", COMPRESSION)
    numbered, last = _with_bases(stored, stored.groupBy(_PART).count().collect(), start)
    ids = (F.col(_BASE) + F.col(_POS) + F.lit(1)).alias(id_col)
    return numbered.select(*[F.col(c) for c in rows.columns], ids), last


def assign_keys_in_groups(rows: DataFrame, natural_key: Sequence[str], id_col: str, start: int) -> tuple[DataFrame, int]:
    """``assign_keys_from`` for rows that are stored together by the first of several key columns (``write_bucketed``).

    Only the sizes of the groups are sorted by range and stored, with what comes before them in their partition. A row's number is
    that of its group and its place in the group, which its key settles, so the rows are neither exchanged nor stored again.
    No key column may be NULL.
    """
    first, *others = natural_key
    groups = rows.groupBy(first).agg(F.count(F.lit(1)).alias(_SIZE))
    ordered = groups.repartitionByRange(first).sortWithinPartitions(first).withColumn(_PART, F.spark_partition_id())
    stored = write_scratch(ordered.withColumn(_POS, _sum_before()(F.col(_SIZE))), "groups", COMPRESSION)
    based, last = _with_bases(stored, stored.groupBy(_PART).agg(F.sum(_SIZE)).collect(), start)
    before = measured(based.select(F.col(first).alias("__group"), (F.col(_BASE) + F.col(_POS)).alias(_BASE)), stored)
    placed = rows.withColumn(_POS, F.row_number().over(Window.partitionBy(first).orderBy(*others)))
    numbered = placed.join(before, placed[first] == before["__group"])
    return numbered.select(*[F.col(c) for c in rows.columns], (F.col(_BASE) + F.col(_POS)).alias(id_col)), last


def _with_bases(stored: DataFrame, counted: Sequence[tuple[int, int]], start: int) -> tuple[DataFrame, int]:
    """Stored partitions with the number of rows ``counted`` before each, after ``start``; and the last number."""
    sizes = sorted(counted)
    bases_before = list(accumulate((n for _, n in sizes), initial=start))
    table = pa.table(
        {
            _PART: pa.array([part for part, _ in sizes], pa.int32()),
            _BASE: pa.array(bases_before[:-1], pa.int64()),
        }
    )
    # One row per shuffle partition, so the broadcast never grows with the data.
    bases = stored.sparkSession.createDataFrame(table)
    return stored.join(F.broadcast(bases), _PART), bases_before[-1]


def _sum_before():
    """The sum of a column over the rows before, along each task's rows."""

    @F.pandas_udf("bigint")
    def before(sizes: Iterator[pd.Series]) -> Iterator[pd.Series]:
        total = 0
        for size in sizes:  # the batches of one task, in order
            upto = size.cumsum() + total
            yield upto - size
            total = int(upto.iloc[-1]) if len(size) else total

    return before.asNondeterministic()
