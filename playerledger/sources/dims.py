"""S3: dimension tables from pipe-delimited text lines.

A dimension maps a key to a display name; the (key, name) pair is picked by
field position.  Lines that are too short, or whose key or name is empty, are
discarded.  A key listed twice keeps its smallest name, so a dimension joins
at most one row per fact row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _picked(lines: DataFrame, key_idx: int, name_idx: int) -> DataFrame:
    parts = F.split(F.col("value"), r"\|", -1)
    return lines.select(F.get(parts, key_idx).alias("k"), F.get(parts, name_idx).alias("n"), "value")


def _usable():
    return F.col("k").isNotNull() & F.col("n").isNotNull() & (F.col("k") != "") & (F.col("n") != "")


def dimension_from_lines(lines: DataFrame, name: str, key_idx: int, name_idx: int,
                         seen: Observation | None = None) -> DataFrame:
    """Frame ``(ref_<name>_id string, <name>_name string)``, one row per key.

    ``seen`` counts the lines read and those discarded, as the dimension is loaded.
    """
    picked = _picked(lines, key_idx, name_idx)
    if seen is not None:
        picked = picked.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(~_usable()).alias("discarded"))
    picked = picked.where(_usable())
    return picked.groupBy(F.col("k").alias(f"ref_{name}_id")).agg(F.min("n").alias(f"{name}_name"))


def dimension_rejects(lines: DataFrame, key_idx: int, name_idx: int) -> DataFrame:
    """The raw lines a dimension load discards (short, empty key or empty name)."""
    return _picked(lines, key_idx, name_idx).where(~_usable()).select("value")


def load_dimension(spark: SparkSession, path: str, name: str, key_idx: int, name_idx: int) -> DataFrame:
    return dimension_from_lines(spark.read.text(path), name, key_idx, name_idx)
