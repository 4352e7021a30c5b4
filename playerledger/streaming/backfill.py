"""T4: backfill from the numbered archive through the same batch function."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..session import list_names
from ..sources.archive import archive_numbers, archive_range_scan
from .batch import Job, process_batch


def numbers_done(job: Job, run: str) -> set[int]:
    """The archive numbers that a run has processed to the end."""
    names = list_names(job.store.spark, f"{job.store.root}/_done/job={run}/batch_id=*")
    return {int(n.removeprefix("batch_id=")) for n in names}


def run_backfill(spark: SparkSession, job: Job, root: str, first: int, last: int, layout: str = "partitioned",
                 slice_size: int = 1, partitions: int | None = None, run: str | None = None, resume: bool = False) -> None:
    """Process the archive numbers from ``first`` to ``last``, ``slice_size`` numbers at a time.

    Every number is a batch of its own: it is written to its own folders, whatever slice
    it comes in, so running a range again, in other slices, rewrites the same batches.
    Only one slice is held at a time.  ``resume`` leaves out the numbers that the run has
    done before.
    """
    run = run or f"{job.name}-backfill"
    done = numbers_done(job, run) if resume else set()
    there = [n for n in archive_numbers(spark, root, layout) if first <= n <= last and n not in done]
    for k, at in enumerate(range(first, last + 1, slice_size)):
        numbers = [n for n in there if at <= n < at + slice_size]
        if not numbers:
            continue
        raw = archive_range_scan(spark, root, numbers[0], numbers[-1], layout, partitions)
        process_batch(job, raw.where(raw["archive_no"].isin(numbers)), numbers[0], run=run, numbers=numbers)
        spark.createDataFrame([(n, n) for n in numbers], "batch_id long, number long").coalesce(1).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{job.store.root}/_done/job={run}")
        if job.compact_every and (k + 1) % job.compact_every == 0:
            job.compact()
