"""Scalar column helpers."""

from batchloom.functions.scalar import (
    any_flag,
    conform,
    day_before,
    empty_table,
    first_of_month,
    flag,
    from_cents,
    saturating_flag,
    stamp,
    to_cents,
)

__all__ = [
    "any_flag", "conform", "day_before", "empty_table", "first_of_month", "flag", "from_cents", "saturating_flag",
    "stamp", "to_cents",
]
