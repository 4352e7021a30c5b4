"""Session helpers: time zone, shared work folder, local session for tests."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


# Event rows are wide (a batch of all pipelines parses ~140 fields and adds 14
# lookup names).  Above ``spark.sql.codegen.maxFields`` (default 100) Spark
# drops whole-stage codegen and copies every row field by field in each
# operator: the 14 lookup joins of a full batch ran ~5x slower that way.
MIN_CODEGEN_FIELDS = 1000


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Session settings the jobs rely on.

    Datetime strings and date parts are computed in UTC; whole-stage codegen
    stays on for wide event rows.
    """
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if int(spark.conf.get("spark.sql.codegen.maxFields", "100")) < MIN_CODEGEN_FIELDS:
        spark.conf.set("spark.sql.codegen.maxFields", str(MIN_CODEGEN_FIELDS))
    return spark


#: Rows of a cached column batch.  A task that reads a block from disk holds up to a hundred
#: batches which no memory manager counts: Java's deserializer forgets what it has read only
#: then.  Of lines in batches of 4 MB, the default's bound, that is 400 MB a task.
CACHED_ROWS = 500


@contextmanager
def plain_cache(spark: SparkSession) -> Iterator[None]:
    """Frames first read inside are cached without column encodings, in small batches.

    The encodings are tried on every value; lines that all differ gain nothing by them,
    and stored blocks are compressed as a whole anyway.
    """
    own = {"spark.sql.inMemoryColumnarStorage.compressed": "false", "spark.sql.inMemoryColumnarStorage.batchSize": str(CACHED_ROWS)}
    before = {key: spark.conf.get(key) for key in own}
    for key, value in own.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, in whatever store ``path`` names."""
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(jsc.hadoopConfiguration()).exists(p)


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The folders and files that match a glob, in whatever store it names."""
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(jsc.hadoopConfiguration()).globStatus(p)
    return [x.getPath().toString() for x in found or []]


def list_names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the folders and files that match a glob."""
    return [p.rsplit("/", 1)[-1] for p in list_paths(spark, pattern)]


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it."""
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(jsc.hadoopConfiguration()).delete(p, True)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may leave it unset (tests, the benchmark): a folder is then
    created and registered, so ``DataFrame.checkpoint()`` and the work folders agree.
    On a cluster a folder of one machine would be lost to the others, so that is an
    error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="playerledger-ckpt-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint root for one run's tables."""
    return f"{checkpoint_root(spark)}/playerledger/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "playerledger",
                  extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.codegen.maxFields", str(MIN_CODEGEN_FIELDS))
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", os.environ.get("PLAYERLEDGER_DRIVER_MEMORY", "8g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
