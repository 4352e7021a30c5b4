"""One batch of raw events through all selected pipelines.

    raw lines -> F1 route (event name)  -> persist once, audit (S9, A2, A3)
              -> for each pipeline: own lines -> S7 typed parse (own fields)
                 -> J1 own lookups -> plan -> its document table

The stream's micro-batches, the archive backfill and the registered queries all
run these functions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import catalog
from ..operators.broadcast import checked_broadcast
from ..operators.enrich import add_event_columns, enrich_with_dims
from ..plans import PLANS, PlanContext
from ..session import ensure_utc, path_exists, plain_cache, remove_path
from ..sinks.doc_table import DocumentStore, DocumentTable
from ..sources.audit import offset_audit
from ..sources.events import CORRUPT_COLUMN, event_name_of, parse_events, to_envelope
from ..sources.rates import day_of, rates_of_days


#: Change rows a writing task takes, about.
ROWS_A_FILE = 50_000
#: Where a batch's lines are kept.  They are many times what executors hold, and serialized
#: blocks in memory (chunks of 1 MB and a header, in heap regions of 1 MB) take twice what
#: Spark counts for them.
LINES_KEPT = StorageLevel.DISK_ONLY


def load_dimensions(loader: Callable[[str], DataFrame], names: Sequence[str],
                    cache: dict | None = None) -> dict[str, DataFrame]:
    """Load, cache and size-check lookups once per process (kept in ``cache``)."""
    out = {}
    for n in names:
        if cache is not None and n in cache:
            out[n] = cache[n]
            continue
        dim = loader(n).persist(StorageLevel.MEMORY_AND_DISK)
        dim = checked_broadcast(dim)
        if cache is not None:
            cache[n] = dim
        out[n] = dim
    return out


_SCHEMAS: dict[str, T.StructType] = {}


def change_schema(spark: SparkSession, pipelines: Sequence[str]) -> T.StructType:
    """The declared columns of the changes of pipelines that share a table: what their plans
    make of no rows, with the optional ``present`` list."""
    out: dict[str, T.DataType] = {}
    for p in pipelines:
        if p not in _SCHEMAS:
            dims = {d: spark.createDataFrame([], f"ref_{d}_id string, {d}_name string") for d in PLANS[p].dims}
            raw = spark.createDataFrame([], "value string")
            changes = pipeline_changes(raw, p, dims, PlanContext(with_present=True))
            rows = PLANS[p].documents(changes).drop("__src")
            _SCHEMAS[p] = rows.schema if "date_part" in rows.columns else rows.withColumn("date_part", F.lit("")).schema
        out |= {f.name: f.dataType for f in _SCHEMAS[p]}
    return T.StructType([T.StructField(n, t) for n, t in out.items()])


@dataclass
class Job:
    """A set of pipelines writing to one document store.

    ``name`` tells the job's batches from those of other jobs on the same tables.
    ``mode`` is "update" (K1) or "append" (K2), for all pipelines or by pipeline;
    ``game`` is put before the table names; with ``compact_every`` a stream
    compacts its tables after so many batches.
    """
    pipelines: Sequence[str]
    dims: Mapping[str, DataFrame]
    store: DocumentStore
    name: str = "job"
    rates: Callable[[int | None], DataFrame] | None = None  # batch time (ms) -> (curr, us_val)
    daily_rates: str | None = None  # folder of daily rates; goes before ``rates``
    mode: str | Mapping[str, str] = "update"
    game: str | None = None
    max_records_per_file: int | None = None
    compact_every: int | None = None
    parallel_writes: int = 4
    keep_dead_letters: bool = True
    with_present: bool = False  # emit each change's written columns (for null_policy="present_wins")
    metrics: list = field(default_factory=list)

    def table(self, pipeline: str) -> DocumentTable:
        return self.store.table(catalog.PIPELINE_TABLE[pipeline][0], self.game)

    def mode_of(self, pipeline: str) -> str:
        return self.mode if isinstance(self.mode, str) else self.mode.get(pipeline, catalog.PIPELINE_MODE[pipeline])

    def compact(self) -> None:
        for name in sorted({catalog.PIPELINE_TABLE[p][0] for p in self.pipelines if self.mode_of(p) == "update"}):
            self.store.table(name, self.game).compact()


def route_batch(raw: DataFrame, pipelines: Sequence[str], batch: Column | None = None) -> DataFrame:
    """F1 once for the whole batch: raw envelope + ``__event``, the routing key.

    ``__event`` is null for lines that can't be routed (not JSON, no event name)
    and empty for events no pipeline wants; the latter keep their position for
    the audit but not their text.  ``__pos`` orders lines of equal time: the offset,
    or the line's hash where the source (files, archives) has none.  ``batch`` tells
    the batches apart when several are taken at once.
    """
    own = [] if batch is None else [batch.cast("long").alias("__batch")]
    raw = to_envelope(raw.select("*", *own), keep=("__batch",) if own else ())
    # a generator's output: no filter on the name is pushed below it, so each line is read once
    raw = raw.select("*", F.explode(F.array(event_name_of())).alias("__name"))
    name = F.col("__name")
    event = F.when(name.isNull() | name.isin(catalog.events_for(pipelines)), name).otherwise("")
    routed = raw.select("*", event.alias("__event"), _position()).drop("__name")
    return routed.withColumn("value", F.when(F.coalesce("__event", F.lit("-")) != "", F.col("value")))


def _position() -> Column:
    return F.coalesce("offset", F.xxhash64("value")).alias("__pos")


def parsed_rows(routed: DataFrame, pipeline: str, fields=None) -> DataFrame:
    """One pipeline's own lines, parsed with its own fields and the corrupt column."""
    plan = PLANS[pipeline]
    mine = routed.where(F.col("__event").isin(list(plan.events))).drop("__event")
    return parse_events(mine, fields or plan.fields, keep_corrupt=True)


def pipeline_rows(routed: DataFrame, pipeline: str, dims: Mapping[str, DataFrame],
                  seen: Observation | None = None) -> DataFrame:
    """One pipeline's enriched rows: narrow parse, own lookups.

    Lines with a wrongly typed field make no document; ``seen`` counts them, and keeps the
    newest time of the lines read.
    """
    parsed = parsed_rows(routed, pipeline)
    if seen is not None:
        parsed = parsed.observe(seen, F.count_if(F.col(CORRUPT_COLUMN).isNotNull()).alias("bad"), F.max("event_ts").alias("newest"))
    parsed = parsed.where(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)
    return add_event_columns(enrich_with_dims(parsed, {d: dims[d] for d in PLANS[pipeline].dims})).drop("__pos")


def pipeline_changes(raw: DataFrame, pipeline: str, dims: Mapping[str, DataFrame],
                     ctx: PlanContext | None = None) -> DataFrame:
    """The change rows of one pipeline from raw lines, as a batch writes them."""
    return PLANS[pipeline].changes(pipeline_rows(route_batch(raw, [pipeline]), pipeline, dims), ctx)


def process_batch(job: Job, raw: DataFrame, batch_id: int, batch_time_ms: int | None = None,
                  run: str | None = None, numbers: Sequence[int] | None = None) -> None:
    """Write the documents of one batch (idempotent per ``run`` and ``batch_id``).

    ``run`` tells runs with batch ids of their own apart (a stream's checkpoint, a
    backfill); default: the job's name.  With ``numbers`` the rows hold several batches,
    told apart by their ``archive_no``: each is written as if it had come alone.  The
    routed batch is persisted and shared by the pipelines, whose tables are written side
    by side; an empty batch writes nothing.  Without ``batch_time_ms`` the batch's time
    is that of its newest event, so a replay gets the same rates.
    """
    spark = ensure_utc(raw.sparkSession)
    run = run or job.name
    one = numbers is None
    numbers = [batch_id] if one else list(numbers)
    # what is kept of a line is kept of unwanted ones too: the position, and the number of a
    # batch that comes alone, are added as the cache is read
    stored = route_batch(raw, job.pipelines, None if one else F.col("archive_no")).drop("__pos").persist(LINES_KEPT)
    routed = stored.select("*", _position(), *([F.lit(batch_id).cast("long").alias("__batch")] if one else []))
    try:
        # fills the cache in one pass: offset ranges, total, routed and unroutable lines; the newest
        # event too, which takes another read of each line, where the rates go by it
        wanted = F.col("__event") != ""
        timed = batch_time_ms is None and job.rates is not None and not job.daily_rates and "deposits" in job.pipelines
        newest = F.max(F.when(wanted, F.get_json_object("value", "$.event_ts").try_cast("long"))) if timed else F.lit(None).cast("long")
        events = {f"n_{e}": F.count_if(F.col("__event") == e) for e in catalog.events_for(job.pipelines)}
        with plain_cache(spark):
            ranges = offset_audit(routed, routed=F.count_if(wanted), unroutable=F.count_if(F.col("__event").isNull()),
                                  newest=newest, **events).collect()  # one row a topic and partition
        if batch_time_ms is None:
            batch_time_ms = max((r["newest"] for r in ranges if r["newest"] is not None), default=None)
        metric = {"run": run, "batch_id": batch_id, "rows": sum(r["routed"] for r in ranges),
                  "messages": sum(r["messages"] for r in ranges), "ranges": [r.asDict() for r in ranges],
                  "dead_letters": sum(r["unroutable"] for r in ranges), "documents": {}, "newest": batch_time_ms if timed else None}
        ctx = PlanContext(with_present=job.with_present)
        daily = None
        if job.daily_rates and "deposits" in job.pipelines:
            paid = parsed_rows(routed, "deposits", [x for x in PLANS["deposits"].fields if x[0] == "event_ts"])
            daily = rates_of_days(spark, job.daily_rates, paid.select(day_of().alias("curr_day"))).persist(StorageLevel.MEMORY_AND_DISK)
            ctx.daily_rates = checked_broadcast(daily)
        elif job.rates is not None and "deposits" in job.pipelines:
            # the currencies of one snapshot
            ctx.rates = F.broadcast(job.rates(batch_time_ms))
        times: dict[str, int | None] = {}  # newest event of each pipeline, as its lines are parsed
        rows_of = {p: sum(r[f"n_{e}"] for e in PLANS[p].events for r in ranges) for p in job.pipelines}

        def write(p: str) -> int:
            table, update = job.table(p), job.mode_of(p) == "update"
            if not rows_of[p]:
                # nothing to write; what the batches left there before is outdated
                for n in {b[2] for b in table.written("changes" if update else "append", p, run)} & set(numbers):
                    table.forget("changes" if update else "append", p, run, n)
                return 0
            typed, kinds = Observation(f"bad-{p}-{batch_id}"), Observation(f"kinds-{p}-{batch_id}")
            changes = PLANS[p].documents(PLANS[p].changes(pipeline_rows(routed, p, job.dims, typed), ctx, kinds))
            # no more files than the rows need
            changes = changes.coalesce(-(-rows_of[p] // ROWS_A_FILE))
            put = table.write_changes if update else table.append_documents
            put(changes, run, numbers, p, job.max_records_per_file)
            try:
                metric["documents"][p] = dict(kinds.get)
                if not timed:
                    times[p] = typed.get["newest"]
                return typed.get["bad"]
            except Py4JJavaError:  # no metric: the plan was cut short, none of its rows were written
                return parsed_rows(routed, p).where(F.col(CORRUPT_COLUMN).isNotNull()).count()

        with ThreadPoolExecutor(max(1, min(job.parallel_writes, len(job.pipelines)))) as pool:
            bad = dict(zip(job.pipelines, pool.map(inheritable_thread_target(spark)(write), job.pipelines)))
        if any(t is not None for t in times.values()):
            metric["newest"] = max(t for t in times.values() if t is not None)
        damaged = [p for p, n in bad.items() if n]
        unroutable, metric["dead_letters"] = metric["dead_letters"], metric["dead_letters"] + sum(bad.values())
        if job.keep_dead_letters:
            _write_dead_letters(job, routed, damaged, bool(unroutable), run, numbers)
        job.metrics.append(metric)
        if daily is not None:
            daily.unpersist()
    finally:
        stored.unpersist()


def _write_dead_letters(job: Job, routed: DataFrame, damaged: Sequence[str], unroutable: bool, run: str, numbers: Sequence[int]) -> None:
    """Lines that can't be routed, and those a pipeline found wrongly typed fields in."""
    base = f"{job.store.root}/_dead_letters/job={run}"
    lost = routed.where(F.col("__event").isNull()).select("value", "topic", "partition", "offset",
                                                          F.lit(None).cast("string").alias("pipeline"), "__batch")
    for p in damaged:
        bad = parsed_rows(routed, p).where(F.col(CORRUPT_COLUMN).isNotNull())
        lost = lost.union(bad.select(F.col(CORRUPT_COLUMN).alias("value"), "topic", "partition", "offset", F.lit(p), "__batch"))
    for n in numbers:
        if path_exists(routed.sparkSession, f"{base}/batch_id={n}"):
            remove_path(routed.sparkSession, f"{base}/batch_id={n}")
    if damaged or unroutable:
        lost.withColumnRenamed("__batch", "batch_id").write.mode("append").partitionBy("batch_id").parquet(base)


def dead_letters(store: DocumentStore) -> DataFrame:
    """``(value, topic, partition, offset, pipeline)`` of all batches; pipeline is null for unroutable lines."""
    base, columns = f"{store.root}/_dead_letters", "value string, topic string, partition int, offset long, pipeline string"
    if not path_exists(store.spark, base):
        return store.spark.createDataFrame([], columns)
    return store.spark.read.schema(columns).parquet(base).select("value", "topic", "partition", "offset", "pipeline")
