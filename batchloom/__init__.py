"""Incremental, batch-loaded dimensional warehouse on PySpark."""

from batchloom.operators.control import Batch

__all__ = ["Batch"]
