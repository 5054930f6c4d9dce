"""Exact distinct counts that can be merged: bitmaps of dense ids.

A count of distinct ids cannot be added up over days. Here every group holds, for each column, a word of 64 bits for each 64 consecutive
ids it meets: the facts are read once, whatever the number of columns, words of days are OR-ed into words of months, and counting is
counting bits. A word is one BIGINT, so it is combined before the shuffle in a plain hash aggregation, and a group holds at most one row
for each different id, however far its ids lie apart; dense ids, as surrogate keys are, share their words. Ids must be whole numbers.
NULL ids are not counted; they make a word without bits, so that a group of NULL ids alone counts 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WHICH, _BUCKET, _BITS = "counted", "bucket", "bits"
# Fixed value: a word has 2 ** 6 bits.
_SHIFT = 6


def distinct_bitmaps(facts: DataFrame, groups: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """One row per group, id column (``counted``) and ``bucket`` of 64 ids with the ``bits`` of the ids met.

    Every column is grouped by its own buckets: grouping by those of several columns together would make a row for each pair of buckets.
    """
    words = [
        F.struct(
            F.lit(c).alias(_WHICH),
            F.shiftright(F.col(c).cast("bigint"), _SHIFT).alias(_BUCKET),
            F.call_function(
                "shiftleft", F.lit(1).cast("bigint"), F.col(c).cast("bigint").bitwiseAND(F.lit((1 << _SHIFT) - 1)).cast("int")
            ).alias(_BITS),
        )
        for c in ids
    ]
    rows = facts.select(*groups, F.explode(F.array(*words)).alias("b")).select(*groups, "b.*")
    return merge_bitmaps(rows, groups)


def merge_bitmaps(bitmaps: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups, or of several tables together."""
    return bitmaps.groupBy(*groups, _WHICH, _BUCKET).agg(F.bit_or(_BITS).alias(_BITS))


def count_bitmaps(bitmaps: DataFrame, groups: Sequence[str], names: Mapping[str, str]) -> DataFrame:
    """One row per group with the number of different ids of each column; ``names`` maps id columns to output columns."""
    counts = [
        F.coalesce(F.sum(F.when(F.col(_WHICH) == c, F.bit_count(_BITS))), F.lit(0)).alias(out) for c, out in names.items()
    ]
    return bitmaps.groupBy(*groups).agg(*counts)


def count_distinct_ids(facts: DataFrame, groups: Sequence[str], names: Mapping[str, str]) -> DataFrame:
    """``count_bitmaps`` of the facts themselves."""
    return count_bitmaps(distinct_bitmaps(facts, groups, list(names)), groups, names)
