"""A1 / L1: latest row per key.

``latest_per_key`` keeps, per key, the row(s) with the greatest order value.
It is a rank filter over a window; Spark plans it with a partial
``WindowGroupLimit`` before the shuffle, so a hot key ships at most its
per-partition leaders (not all its rows) to the final task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def max_per_key(df: DataFrame, keys: Sequence[str], order: str = "event_ts", alias: str = "max_ts") -> DataFrame:
    """A1: ``max(order)`` per key (partial aggregation before the shuffle)."""
    return df.groupBy(*keys).agg(F.max(order).alias(alias))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str = "event_ts", ties: bool = True,
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """L1: rows whose ``order`` is the maximum of their key.

    ``ties=True`` keeps every row at the maximum (rows with equal order are all
    latest).  ``ties=False`` keeps one row per key, chosen by ``tiebreak``
    (descending) after ``order``.  Rows with a null key or null order are not
    candidates.  Of several batches taken at once (``__batch``) each has its own.
    """
    keys = [*keys, *(["__batch"] if "__batch" in df.columns else [])]
    cand = df.where(F.col(order).isNotNull())
    for k in keys:
        cand = cand.where(F.col(k).isNotNull())
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc(), *[F.col(c).desc() for c in tiebreak])
    fn = F.rank() if ties else F.row_number()
    return cand.withColumn("__rk", fn.over(w)).where(F.col("__rk") == 1).drop("__rk")
