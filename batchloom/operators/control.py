"""Batch control row and batch log."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchloom.functions import stamp

OPEN, CLOSED = "O", "C"


@dataclass(frozen=True)
class Batch:
    """One run: its number, its lower date bound and the run-start time used for every audit stamp."""

    no: int
    date: dt.date
    run_at: dt.datetime

    @property
    def no_col(self):
        return F.lit(self.no).cast("int")

    @property
    def date_col(self):
        return F.lit(self.date)

    @property
    def run_col(self):
        return stamp(self.run_at)


def read_control(control: DataFrame, run_at: dt.datetime) -> Batch:
    """The single control row as plain values, used as literals from here on."""
    row = control.select("etl_batch_no", "etl_batch_date").first()
    if row is None:
        raise ValueError("batch_control holds no row")
    return Batch(int(row[0]), row[1], run_at)


def stamp_batch(df: DataFrame, batch: Batch) -> DataFrame:
    """Add the batch columns as literals; no join with the control table is needed."""
    return df.withColumns({"etl_batch_no": batch.no_col, "etl_batch_date": batch.date_col})


def open_batch(log: DataFrame, batch: Batch) -> DataFrame:
    """Append the log row of a starting batch."""
    opened = log.sparkSession.range(1).select(
        batch.no_col.alias("etl_batch_no"),
        batch.date_col.alias("etl_batch_date"),
        F.lit(OPEN).alias("etl_batch_status"),
        batch.run_col.alias("etl_batch_start_time"),
        F.lit(None).cast("timestamp").alias("etl_batch_end_time"),
    )
    return log.unionByName(opened)


def close_batch(log: DataFrame, batch: Batch, ended_at: dt.datetime) -> DataFrame:
    """Set status and end time on the rows of this batch; a batch that is not open is an error."""
    is_open = (F.col("etl_batch_no") == batch.no) & (F.col("etl_batch_status") == OPEN)
    if log.where(is_open).limit(1).isEmpty():
        raise ValueError(f"batch {batch.no} is not open")
    this_batch = F.col("etl_batch_no") == batch.no
    return log.withColumns(
        {
            "etl_batch_status": F.when(this_batch, F.lit(CLOSED)).otherwise(F.col("etl_batch_status")),
            "etl_batch_end_time": F.when(this_batch, stamp(ended_at)).otherwise(F.col("etl_batch_end_time")),
        }
    )
