"""Dimension names and currency rates by left outer equi-joins.

The fact key is cast to string before the join, since dimension keys are
strings and some fact keys are ints (no implicit cast that could fail on an
empty key).  Dimensions hold one row per key, so a join never multiplies
fact rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import DIM_FACT_KEY
from ..functions.time import epoch_ms_to_datetime


def enrich_with_dims(df: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Add ``<dim>_name`` for each dimension in ``dims`` (already size-checked)."""
    out = df
    for name, dim in dims.items():
        fact_key = DIM_FACT_KEY[name]
        ref = f"ref_{name}_id"
        if fact_key not in out.columns:
            out = out.withColumn(f"{name}_name", F.lit(None).cast("string"))
            continue
        name_col = f"{name}_name"
        if name_col in out.columns:
            # an event field of the same name exists (product_name of product
            # movements): keep the lookup under a hidden name; the pipeline that
            # asked for this dimension maps it back (EventPlan.prepare)
            dim = dim.withColumnRenamed(name_col, "__dim_" + name_col)
        out = (out.join(dim, out[fact_key].cast("string") == dim[ref], "left")
               .drop(ref))
    return out


def add_event_columns(df: DataFrame) -> DataFrame:
    """``event_datetime`` string and the hidden source position ``__src``.

    ``__src`` = (event_ts, partition, offset) orders partial documents in the
    keyed merge; it belongs to the row, so replays and re-splits give the same
    order.  ``__pos`` stands for the offset where a source has none.
    """
    offset = next((c for c in ("__pos", "offset") if c in df.columns), None)
    src = F.struct(F.col("event_ts").alias("ts"),
                   F.col("partition").alias("partition") if "partition" in df.columns else F.lit(None).cast("int").alias("partition"),
                   (F.col(offset) if offset else F.lit(None).cast("long")).alias("offset"))
    return df.withColumn("event_datetime", epoch_ms_to_datetime("event_ts")).withColumn("__src", src)


def join_rates(df: DataFrame, rates: DataFrame, currency_col: str = "deposit_currency") -> DataFrame:
    """Attach ``us_val`` by currency code (rates: one row per currency, small)."""
    r = rates.select(F.col("curr"), F.col("us_val"))
    return df.join(r, df[currency_col] == r["curr"], "left").drop("curr")


def join_daily_rates(df: DataFrame, rates: DataFrame, day: Column, currency_col: str = "deposit_currency") -> DataFrame:
    """Attach ``curr_day`` and that day's ``us_val`` (rates: one row per day and currency)."""
    r = rates.select(F.col("curr_day").alias("__day"), "curr", "us_val")
    rows = df.withColumn("curr_day", day)
    return rows.join(r, (rows["curr_day"] == r["__day"]) & (rows[currency_col] == r["curr"]), "left").drop("__day", "curr")
