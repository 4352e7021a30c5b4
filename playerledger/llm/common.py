"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playerledger.session import work_folder

#: White space of the word definition: space and tab..carriage return.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


#: Bytes of rows handed to a Python worker at once: bounds both sides' memory whatever the rows' length.
BATCH_BYTES = 16 << 20
#: Let a worker give large arrays back to the system when they are freed.
WORKER_ENV = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_MMAP_THRESHOLD_": "4194304",
    "MALLOC_TRIM_THRESHOLD_": "8388608",
}


def workers_ready(spark: SparkSession) -> None:
    """Settings of the Python workers: small batches, and this package importable.

    The package is found where the driver has it, which is enough for local
    sessions and shared installations; other clusters have it installed or shipped
    with ``--py-files``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    for k, v in WORKER_ENV.items():
        env.setdefault(k, v)


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where this machine (the same on every executor) has a public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared work folder and read it back.

    Cuts the lineage with a table every executor can reach, so a lost executor
    never means recomputing what came before.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark, name)}.parquet"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Array of words (runs of anything but space and tab..carriage return); null text: empty."""
    inner = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+", -1))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body reads it."""
    return F.transform(F.array(value), body)[0]


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_new(df: DataFrame, **columns: Column) -> DataFrame:
    """Add result columns; an input column of the same name (in any case) gives way."""
    clash = {c.lower() for c in columns}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in clash],
                     *[v.alias(k) for k, v in columns.items()])
