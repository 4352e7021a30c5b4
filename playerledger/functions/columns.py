"""Projection helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fill_status(df: DataFrame, column: str = "transaction_status_id", value: int = -1) -> DataFrame:
    """A missing status means the approved path (-1)."""
    return df.na.fill(value, [column])


def usd_amount(amount, rate) -> Column:
    """P10: amount / rate; a zero or missing rate gives null instead of failing."""
    a = F.col(amount) if isinstance(amount, str) else amount
    r = F.col(rate) if isinstance(rate, str) else rate
    return F.try_divide(a, r)
