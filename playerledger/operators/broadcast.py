"""Broadcast only behind a size check.

A lookup side is broadcast when the hash table made of it is within a bound; above it
the join is left to the planner (shuffle join, which AQE may still turn into a
broadcast at run time).  Lookups are cached once per process by their owners, so
their rows and their size in bytes are known after one count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 64 << 20
#: Bytes that a row of two short strings takes in a join's hash table (pointers, lengths, the
#: key twice), about; the driver and every executor hold that table, uncompressed.
HASHED_ROW = 150


def checked_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if the hash table of the cached frame ``df`` takes at most ``max_bytes``, about, else ``df`` unchanged."""
    rows = df.count()  # fills the cache: the plan's size is measured, not estimated
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size + rows * HASHED_ROW <= max_bytes else df
