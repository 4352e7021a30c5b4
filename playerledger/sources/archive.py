"""Numbered archive folders read as one batch of raw event lines.

Two layouts:

* ``partitioned``: ``<root>/archive_no=<N>/...`` - a partition column, so the
  range predicate prunes folders at planning time.
* ``numbered``: ``<root><N>/*`` - the wanted numbers that exist are read, so only
  those folders are listed.

A missing number is skipped.  An archive that is not there at all (no such root,
no numbered folder, no partition column) is an error, not an empty batch.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import list_names
from .events import to_envelope

_EMPTY = "value string, topic string, partition int, offset long, archive_no int"


def archive_numbers(spark: SparkSession, root: str, layout: str = "partitioned") -> list[int]:
    """The numbers the archive holds, ascending; raises when it holds none."""
    if layout not in ("partitioned", "numbered"):
        raise ValueError(f"unknown archive layout {layout!r}")
    pattern, name = (f"{root.rstrip('/')}/archive_no=*", r"archive_no=(\d+)") if layout == "partitioned" else (
        f"{root}*", re.escape(root.rstrip("/").rsplit("/", 1)[-1] if not root.endswith("/") else "") + r"(\d+)")
    found = sorted(int(m[1]) for n in list_names(spark, pattern) if (m := re.fullmatch(name, n)))
    if not found:
        raise FileNotFoundError(f"no archive folders like {pattern}")
    return found


def archive_range_scan(spark: SparkSession, root: str, first: int, last: int,
                       layout: str = "partitioned", min_partitions: int | None = None) -> DataFrame:
    wanted = [n for n in archive_numbers(spark, root, layout) if first <= n <= last]
    if not wanted:
        return spark.createDataFrame([], _EMPTY)
    if layout == "partitioned":
        df = spark.read.option("basePath", root).text(root).where(F.col("archive_no").between(first, last))
        out = to_envelope(df.withColumn("archive_no", F.col("archive_no").cast("int")), keep=("archive_no",))
    else:
        df = spark.read.text([f"{root}{n}/*" for n in wanted])
        num = F.regexp_extract(F.col("_metadata.file_path"), r"(\d+)/[^/]*$", 1).cast("int")
        out = to_envelope(df.select("value", num.alias("archive_no")), keep=("archive_no",))
    return out.repartition(min_partitions) if min_partitions else out
