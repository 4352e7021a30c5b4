"""Batch function, stream and backfill."""

from .backfill import numbers_done, run_backfill
from .batch import Job, dead_letters, load_dimensions, pipeline_changes, pipeline_rows, process_batch, route_batch
from .stream import run_stream

__all__ = ["Job", "dead_letters", "load_dimensions", "pipeline_changes", "pipeline_rows", "process_batch", "route_batch",
           "run_stream", "run_backfill", "numbers_done"]
