"""Registered queries: one per operator / pipeline, over the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  All of them
read the parquet tables (through ``driver_tables``) and run the library's own
code path, the one jobs run, so their work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import catalog, schema
from . import driver_tables as dt
from .functions import day_key, doc_id, epoch_ms_to_datetime, event_time, month_part, week_part
from .functions.columns import fill_status, usd_amount
from .functions.keys import KEY_SHAPES
from .operators.broadcast import checked_broadcast
from .operators.enrich import join_daily_rates, join_rates
from .operators.latest import latest_per_key, max_per_key
from .operators.merge import merge_documents, seq_column
from .plans import PLANS, PlanContext
from .session import ensure_utc, work_folder
from .sinks.doc_table import DocumentStore
from .sources.archive import archive_range_scan
from .sources.audit import RANGES, offset_audit, source_ranges
from .sources.dims import dimension_from_lines
from .sources.events import parse_events, prefilter_event_names, prefilter_product_action
from .sources.rates import (
    currency_rates, daily_currency_rates, day_of, latest_rates, rates_of_days, rates_with_refresh, store_daily_rates)
from .streaming.backfill import run_backfill
from .streaming.batch import (
    Job, dead_letters, load_dimensions, pipeline_changes, pipeline_rows, process_batch, route_batch)
from .streaming.stream import run_stream

ALL = list(catalog.PIPELINE_EVENTS)

# Lookups are loaded once per process and session, like a long-running job does.
_DIM_CACHE: dict = {}


def _session_key(spark: SparkSession):
    try:
        return spark.sparkContext.applicationId
    except Exception:  # sessions without a SparkContext handle
        return id(spark)


def _dims(spark: SparkSession, sf: str, names) -> dict[str, DataFrame]:
    key = (_session_key(spark), sf)
    cache = _DIM_CACHE.setdefault(key, {})

    def loader(d):
        k, n = catalog.DIM_POSITIONS[d]
        return dimension_from_lines(dt.dimension_lines(spark, sf, d), d, k, n)
    return load_dimensions(loader, list(names), cache)


def release_dimensions() -> None:
    """Drop the lookups kept for this process; the next query loads them anew."""
    for cache in _DIM_CACHE.values():
        for dim in cache.values():
            dim.unpersist()
    _DIM_CACHE.clear()


def enriched(spark: SparkSession, sf: str, pipeline: str) -> DataFrame:
    """One pipeline's rows, as a batch parses and enriches them."""
    lines = dt.game_event_lines(spark, sf, [pipeline])
    return pipeline_rows(route_batch(lines, [pipeline]), pipeline, _dims(spark, sf, PLANS[pipeline].dims))


def parsed(spark: SparkSession, sf: str, pipelines, fields) -> DataFrame:
    """Routed lines of ``pipelines`` with only ``fields`` parsed."""
    lines = route_batch(dt.game_event_lines(spark, sf, pipelines), pipelines).where(F.col("__event") != "")
    return parse_events(lines, [(n, k) for n, k in schema.ALL_FIELDS if n in fields], keep_corrupt=False)


def newest_rates(spark: SparkSession, sf: str) -> DataFrame:
    """The currencies of one snapshot: small enough to broadcast uncounted."""
    return F.broadcast(latest_rates(dt.rate_snapshots(spark, sf)).select("curr", "us_val"))


def changes(spark: SparkSession, sf: str, pipeline: str) -> DataFrame:
    ctx = PlanContext(rates=newest_rates(spark, sf) if pipeline == "deposits" else None)
    return pipeline_changes(dt.game_event_lines(spark, sf, [pipeline]), pipeline, _dims(spark, sf, PLANS[pipeline].dims), ctx)


def _public(df: DataFrame) -> DataFrame:
    out = df.drop("__src")
    if "doc" in out.columns:
        out = out.withColumn("doc", F.to_json("doc")).withColumnRenamed("doc", "doc_json")
    return out


def _change_rows(df: DataFrame) -> DataFrame:
    """Changes with date_part and seq, ready for the merge."""
    if "date_part" not in df.columns:
        df = df.withColumn("date_part", F.lit(catalog.NO_DATE_PART))
    return df.withColumn("seq", seq_column()).drop("__src")


# --------------------------------------------------------------------------
# Partial documents of each pipeline
# --------------------------------------------------------------------------

def _pipeline_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark, sf):
        return _public(changes(spark, sf, name))
    q.__name__ = f"changes_{name}"
    return q


# --------------------------------------------------------------------------
# Sources and filters
# --------------------------------------------------------------------------

def f1_prefilter(spark, sf):
    ensure_utc(spark)
    names = catalog.events_for(["sessions", "deposits"])
    lines = prefilter_event_names(dt.game_event_lines(spark, sf, ALL), names, "event_name")
    return lines.select("topic", "partition", "offset", "event_name")


def f4_product_action(spark, sf):
    ensure_utc(spark)
    lines = prefilter_product_action(dt.game_event_lines(spark, sf, ["prodMove"]), 3)
    return lines.select("topic", "partition", "offset")


def s7_parse(spark, sf):
    ensure_utc(spark)
    fields = schema.union_fields(*(PLANS[p].fields for p in ALL))
    shown = ["event_name", "player_id", "cluster_id", "event_ts", "network_id", "deposit_amount", "level_id", "keyid"]
    parsed = parse_events(dt.game_event_lines(spark, sf, ALL), fields, keep_corrupt=True, only=shown)
    return parsed.select("topic", "partition", "offset", *shown, "_corrupt_record")


def s9_offset_audit(spark, sf):
    ensure_utc(spark)
    return offset_audit(dt.game_event_lines(spark, sf, ALL))


def s3_dim_load(spark, sf):
    frames = []
    for d in catalog.DIM_POSITIONS:
        k, n = catalog.DIM_POSITIONS[d]
        dim = dimension_from_lines(dt.dimension_lines(spark, sf, d), d, k, n)
        frames.append(dim.select(F.lit(d).alias("dim"), F.col(f"ref_{d}_id").alias("ref_id"),
                                 F.col(f"{d}_name").alias("name")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def s4_rates_explode(spark, sf):
    ensure_utc(spark)
    return currency_rates(dt.rate_snapshots(spark, sf))


def s5_daily_rates(spark, sf):
    ensure_utc(spark)
    return daily_currency_rates(dt.daily_rate_lines(spark, sf))


def s5_daily_usd(spark, sf):
    """Deposit amounts in dollars by the rate of their own day and currency.

    The rates are stored by month; those of the feed's days are read, and broadcast
    when they are small.
    """
    path = work_folder(spark, "daily-rates")
    store_daily_rates(daily_currency_rates(dt.daily_rate_lines(spark, sf)), path)
    rows = parsed(spark, sf, ["deposits"], {"deposit_currency", "deposit_amount", "event_ts"})
    rates = rates_of_days(spark, path, rows.select(day_of().alias("curr_day")))
    j = join_daily_rates(rows, checked_broadcast(rates.persist()), day_of())
    return j.select("partition", "offset", "deposit_currency", "curr_day", "us_val",
                    usd_amount("deposit_amount", "us_val").alias("usd_deposit"))


# A fixed probe time (1998-08-02 13:00 UTC): 13 h after that day's snapshot.
S6_AT_MS = 902062800000


def s6_latest_rates(spark, sf):
    ensure_utc(spark)
    return latest_rates(dt.rate_snapshots(spark, sf), at_ms=S6_AT_MS)


# Batch times: before all snapshots, at one, within its refresh age, and long after the last.
S6_TIMES = (600000000000, 902016000000, 902016000000 + catalog.RATE_TTL_MS, S6_AT_MS, 1000000000000)


def s6_rates_refresh(spark, sf):
    """A job's rate provider asked at several batch times."""
    snapshots = dt.rate_snapshots(spark, sf)
    provider = rates_with_refresh(lambda: snapshots)
    out = None
    for t in S6_TIMES:
        rates = provider(t).select(F.lit(t).cast("long").alias("at_ms"), "curr", "us_val", "as_of", "stale")
        out = rates if out is None else out.unionByName(rates)
    return out


def s2_archive_range(spark, sf):
    """Lines archived by day of month into ``archive_no=<d>`` folders; read days 10..40."""
    ensure_utc(spark)
    root = work_folder(spark, "archive")
    lines = dt.game_event_lines(spark, sf, ["sessions"])
    ts = F.timestamp_millis(F.get_json_object("value", "$.event_ts").cast("long"))
    (lines.withColumn("archive_no", F.dayofmonth(ts))
     .select(F.to_json(F.struct("value", "topic", "partition", "offset")).alias("line"), "archive_no")
     .hint("rebalance", "archive_no").write.mode("overwrite").partitionBy("archive_no").text(root))
    raw = archive_range_scan(spark, root, 10, 40, layout="partitioned")
    env = F.from_json("value", "value string, topic string, partition int, offset long")
    return raw.select(env.alias("e"), "archive_no").select("e.topic", "e.partition", "e.offset", "archive_no")


# --------------------------------------------------------------------------
# Functions and projections
# --------------------------------------------------------------------------

def _orders_ms(spark, sf):
    ensure_utc(spark)
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.select("o_orderkey", "o_custkey", "o_orderdate", F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ms"))


def p1_datetime(spark, sf):
    ensure_utc(spark)
    e = spark.read.parquet(f"{sf}/events.parquet")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return e.select("event_id", ms.alias("event_ts"), epoch_ms_to_datetime(ms).alias("event_datetime"))


def p2_week(spark, sf):
    o = _orders_ms(spark, sf)
    return o.select("o_orderkey", week_part(event_time("ms")).alias("date_part"))


def p3_month(spark, sf):
    o = _orders_ms(spark, sf)
    return o.select("o_orderkey", month_part(event_time("ms")).alias("date_part"))


def p4_day(spark, sf):
    o = _orders_ms(spark, sf)
    return o.select("o_orderkey", day_key(event_time("ms")).alias("day"))


def p5_doc_id(spark, sf):
    """The seven id shapes over the parsed rows of all pipelines."""
    rows = parsed(spark, sf, ALL, {n for parts in KEY_SHAPES.values() for n in parts})
    return rows.select("topic", "partition", "offset",
                       *[doc_id(*parts).alias(f"id_{name}") for name, parts in KEY_SHAPES.items()])


def p9_fill(spark, sf):
    rows = parsed(spark, sf, ["deposits"], {"event_name", "transaction_status_id"})
    return fill_status(rows.where(F.col("event_name") == "TRANSACTION_RESULT")).select("offset", "transaction_status_id")


def p10_usd(spark, sf):
    rows = parsed(spark, sf, ["deposits"], {"deposit_currency", "deposit_amount"})
    j = join_rates(rows, newest_rates(spark, sf))
    return j.select("partition", "offset", "deposit_currency", usd_amount("deposit_amount", "us_val").alias("usd_deposit"))


def j2_rates(spark, sf):
    rows = parsed(spark, sf, ["deposits"], {"deposit_currency"})
    return join_rates(rows, newest_rates(spark, sf)).select("partition", "offset", "deposit_currency", "us_val")


def f3_predicates(spark, sf):
    rows = parsed(spark, sf, ["set_level"], {"event_name", "player_id", "level_type_id", "level_id"})
    keep = (F.col("event_name") == "SET_LEVEL") & ((F.col("level_type_id") == 1) | (F.col("level_type_id") == 2))
    return rows.where(keep).select("offset", "player_id", "level_type_id", "level_id")


def p12_sparse_map(spark, sf):
    return _public(changes(spark, sf, "userGameProfile")).select("id", "doc_json")


def j1_dims(spark, sf):
    """Lookup names of two pipelines' rows; a lookup the other pipeline joins is null."""
    rows = enriched(spark, sf, "sessions").unionByName(enriched(spark, sf, "progress"), allowMissingColumns=True)
    return rows.select("topic", "partition", "offset", "event_name", "cluster_name", "network_name",
                       "country_name", "device_name", "progress_type_name", "progress_status_name", "quest_name")


def _profile_rows(spark, sf):
    rows = parsed(spark, sf, ["profile"], {"event_name", "player_id", "cluster_id", "event_ts"})
    return rows.where(F.col("event_name") == "USER_PROFILE")


def a1_max(spark, sf):
    return max_per_key(_profile_rows(spark, sf), ["player_id", "cluster_id"], "event_ts", "max_ts")


def _daily_profile_rows(spark, sf):
    # order by day so that several events of one day tie
    return _profile_rows(spark, sf).withColumn("day_ms", F.unix_millis(F.date_trunc("day", event_time("event_ts"))))


def l1_latest_ties(spark, sf):
    rows = _daily_profile_rows(spark, sf)
    return latest_per_key(rows, ["player_id", "cluster_id"], "day_ms", ties=True).select(
        "player_id", "cluster_id", "day_ms", "offset")


def l1_latest_one(spark, sf):
    rows = _daily_profile_rows(spark, sf)
    return latest_per_key(rows, ["player_id", "cluster_id"], "day_ms", ties=False, tiebreak=["offset"]).select(
        "player_id", "cluster_id", "day_ms", "offset")


# --------------------------------------------------------------------------
# Merge and sinks
# --------------------------------------------------------------------------

def k1_merge(spark, sf):
    """Deposit documents: send and status writes folded per (month, transaction)."""
    return merge_documents(_change_rows(changes(spark, sf, "deposits")))


def _job(spark, sf, pipelines, folder, **more) -> Job:
    ensure_utc(spark)
    # the tables without a date split come from the events: their buckets follow these
    store = DocumentStore(spark, work_folder(spark, folder), buckets=max(8, dt.event_tasks(spark, sf)))
    return Job(pipelines=pipelines, dims=_dims(spark, sf, catalog.dims_for(pipelines)), store=store, **more)


def _cut(lines: DataFrame, parts: int) -> list[DataFrame]:
    """The feed in parts that keep a player together."""
    part = F.pmod(F.xxhash64(F.get_json_object("value", "$.player_id")), F.lit(parts))
    return [lines.where(part == k) for k in range(parts)]


def k4_player360(spark, sf):
    """Player profiles from a job of four pipelines: two batches, compacted between."""
    pipelines = ["userGameProfile", "profile", "regs", "set_level"]
    job = _job(spark, sf, pipelines, "player360")
    for batch_id, some in enumerate((pipelines[:2], pipelines[2:])):
        process_batch(job, dt.game_event_lines(spark, sf, some), batch_id)
        if batch_id == 0:
            job.compact()
    return job.table("profile").documents()


def k2_append(spark, sf):
    """Battle documents by a job in append mode: stored as they come, read back."""
    job = _job(spark, sf, ["battle"], "append", mode="append", game="arena", max_records_per_file=100_000)
    process_batch(job, dt.game_event_lines(spark, sf, ["battle"]), 0)
    return job.table("battle").appended()


def k3_partitioned(spark, sf):
    """Deposit documents compacted into a date-split snapshot; a month range read back."""
    job = _job(spark, sf, ["deposits"], "dated")
    table = job.table("deposits")
    table.write_changes(changes(spark, sf, "deposits"), "once", 0, "deposits")
    table.compact()
    return table.documents().where(F.col("date_part") >= "1998-01")


def _contents(docs: DataFrame, table: str) -> DataFrame:
    """For each field of a document table: values set, and the least and largest as text."""
    fields = [f for f in docs.schema if f.name not in ("date_part", "id")]

    def text(f):
        # whole cents, so that engines print the same text
        return F.round(F.col(f.name) * 100).cast("long").cast("string") if f.dataType.simpleString() == "double" else (
            F.col(f.name).cast("string"))
    stats = [F.struct(F.lit(f.name).alias("field"), F.count(f.name).alias("n"), F.min(text(f)).alias("least"),
                      F.max(text(f)).alias("largest")) for f in fields]
    stats.append(F.struct(F.lit("id").alias("field"), F.count("id").alias("n"), F.min("id").alias("least"),
                          F.max("id").alias("largest")))
    return docs.agg(F.array(*stats).alias("s")).select(F.lit(table).alias("doc_table"), F.inline("s"))


def _all_contents(job: Job) -> DataFrame:
    out = None
    for t in sorted({catalog.PIPELINE_TABLE[p][0] for p in job.pipelines}):
        c = _contents(job.store.table(t).documents(), t)
        out = c if out is None else out.unionByName(c)
    return out


def t1_stream_equals_batch(spark, sf):
    """All eleven pipelines from a file stream in several micro-batches, compacted on the way."""
    job = _job(spark, sf, ALL, "stream", rates=rates_with_refresh(dt.rate_snapshots(spark, sf).persist()), compact_every=2)
    src = work_folder(spark, "stream-src")
    # files keep a player together, so latest-per-player rows do not depend on the cut
    player = F.get_json_object("value", "$.player_id")
    lines, files = dt.game_event_lines(spark, sf, ALL), int(spark.conf.get("spark.sql.shuffle.partitions"))
    many = dt.feed_files(spark, sf)
    # more of them where the session's number would make files too large for a task
    lines = lines.repartition(player) if many <= files else lines.repartition(many, player)
    lines.write.mode("overwrite").parquet(src)
    files = max(files, many)
    q = run_stream(spark, job, {"format": "parquet", "path": src}, name="all", available_now=True,
                   checkpoint=f"{job.store.root}/_checkpoint", max_per_trigger=max(1, files // 2))
    q.awaitTermination()
    return _all_contents(job)


def t4_backfill(spark, sf):
    """Progress documents backfilled from the numbered archive (one folder a day), a week a batch."""
    job = _job(spark, sf, ["progress"], "progress", compact_every=2)
    root = _progress_archive(spark, sf)
    run_backfill(spark, job, f"{root}/archive_no=", 1, 40, layout="numbered", slice_size=7)
    return job.table("progress").documents()


def _progress_archive(spark, sf) -> str:
    """The progress feed as a numbered archive, one folder a day of the month."""
    root = work_folder(spark, "progress-archive")
    lines = dt.game_event_lines(spark, sf, ["progress"])
    ts = F.timestamp_millis(F.get_json_object("value", "$.event_ts").cast("long"))
    (lines.select("value", F.dayofmonth(ts).alias("archive_no"))
     .hint("rebalance", "archive_no").write.mode("overwrite").partitionBy("archive_no").text(root))
    return root


def t5_backfill_back(spark, sf):
    """A later archive range first, compacted, then the earlier one, out of order and once more in part."""
    job = _job(spark, sf, ["progress"], "back")
    root = _progress_archive(spark, sf)
    run_backfill(spark, job, root, 10, 40, slice_size=11)
    job.compact()
    run_backfill(spark, job, root, 5, 9, slice_size=5)
    run_backfill(spark, job, root, 1, 4, slice_size=2)
    job.compact()
    run_backfill(spark, job, root, 8, 12, slice_size=3)
    return job.table("progress").documents()


def t4_backfill_resume(spark, sf):
    """The archive in slices of 7 and then of 1, merged and appended; what each table holds by document."""
    root = _progress_archive(spark, sf)
    out = None
    for mode in ("update", "append"):
        job = _job(spark, sf, ["progress"], f"resume-{mode}", mode=mode)
        run_backfill(spark, job, root, 1, 20, slice_size=7)
        run_backfill(spark, job, root, 1, 40, slice_size=7, resume=True)
        run_backfill(spark, job, root, 18, 22, slice_size=1)
        table = job.table("progress")
        docs = table.documents() if mode == "update" else table.appended()
        stats = docs.groupBy("date_part", "id").agg(F.count(F.lit(1)).alias("n"), *[
            F.count(f"{k}_datetime").alias(f"n_{k}") for k in ("open", "start", "finish")])
        stats = stats.select(F.lit(mode).alias("mode"), "*")
        out = stats if out is None else out.unionByName(stats)
    return out


def t3_shared_batch(spark, sf):
    """All eleven pipelines in one batch on one routed feed; what every table holds, field by field."""
    rates = newest_rates(spark, sf)
    job = _job(spark, sf, ALL, "all", rates=lambda _t: rates)
    process_batch(job, dt.game_event_lines(spark, sf, ALL), 0)
    return _all_contents(job)


def t5_late_replay(spark, sf):
    """Deposit batches processed newest first, one replayed, compaction between.

    Documents must equal merging all changes at once (event-time order).
    """
    rates = newest_rates(spark, sf)
    job = _job(spark, sf, ["deposits"], "late", rates=lambda _t: rates)
    # the simulated source holds the feed once, as a broker would; each batch reads its slice
    year = F.year(F.timestamp_millis(F.get_json_object("value", "$.event_ts").cast("long")))
    lines = dt.game_event_lines(spark, sf, ["deposits"]).withColumn("__year", year).persist()
    buckets = [F.col("__year") >= 1999, F.col("__year") < 1997,
               (F.col("__year") >= 1997) & (F.col("__year") < 1999)]
    try:
        for batch_id, cond in enumerate(buckets):
            process_batch(job, lines.where(cond).drop("__year"), batch_id)
            if batch_id == 1:
                job.compact()
        process_batch(job, lines.where(buckets[0]).drop("__year"), 0)  # replay of the first batch
    finally:
        lines.unpersist()
    return job.table("deposits").documents()


def t5_two_jobs(spark, sf):
    """Two jobs and a backfill on the player profiles, with batch ids of their own.

    Job one writes batches 0 to 3 and is compacted; then job two starts at 0, a
    backfill writes its 0, job two its 1, and job one's batch 2 is replayed.  The
    documents must equal merging everything at once.
    """
    one = _job(spark, sf, ["profile"], "two-jobs", name="one")
    two = _job(spark, sf, ["regs"], "two-jobs", name="two")
    levels = _job(spark, sf, ["set_level"], "two-jobs", name="levels")
    two.store = levels.store = one.store
    profiles = _cut(dt.game_event_lines(spark, sf, ["profile"]), 4)
    regs = _cut(dt.game_event_lines(spark, sf, ["regs"]), 2)
    for k, lines in enumerate(profiles):
        process_batch(one, lines, k)
    one.compact()
    process_batch(two, regs[0], 0)
    process_batch(levels, dt.game_event_lines(spark, sf, ["set_level"]), 0, run="levels-backfill")
    two.compact()
    process_batch(two, regs[1], 1)
    process_batch(one, profiles[2], 2)
    return one.table("profile").documents()


def s7_dead_letters(spark, sf):
    """What a job keeps of damaged lines: a derived share of the feed is no JSON, has a
    wrongly typed time, or lacks its player."""
    job = _job(spark, sf, ["regs"], "damaged")
    kind = F.col("offset") % 7
    damaged = (F.when(kind == 0, F.concat(F.lit("x"), F.col("value")))
               .when(kind == 1, F.regexp_replace("value", r'"event_ts":(\d+)', '"event_ts":"late $1"'))
               .when(kind == 2, F.regexp_replace("value", r'"player_id":"[^"]*",', ""))
               .otherwise(F.col("value")))
    process_batch(job, dt.game_event_lines(spark, sf, ["regs"]).withColumn("value", damaged), 0)
    lost = dead_letters(job.store).select(F.when(F.col("pipeline").isNull(), "unroutable").otherwise("wrong type").alias("kind"),
                                          "partition", "offset")
    rejects = job.table("regs").rejects().select(F.lit("no id").alias("kind"), "seq.partition", "seq.offset")
    good = job.table("regs").documents().agg(F.count("id").alias("n")).select(
        F.lit("documents").alias("kind"), F.lit(None).cast("int").alias("partition"), F.col("n").alias("offset"))
    return lost.unionByName(rejects).unionByName(good)


def s9_batch_metrics(spark, sf):
    """A batch's offset ranges, messages and routed lines, as the job records them."""
    job = _job(spark, sf, ["sessions"], "metrics")
    process_batch(job, dt.game_event_lines(spark, sf, ALL), 0)
    m = job.metrics[-1]
    rows = [(m["messages"], m["rows"], *[r[k] for k in ("topic", "partition", "from_offset", "until_offset", "messages", "routed")])
            for r in m["ranges"]]
    return spark.createDataFrame(rows, "total long, rows long, topic string, partition int, from_offset long, "
                                       "until_offset long, messages long, routed long")


def s9_stream_progress(spark, sf):
    """What a file stream's own progress and its batches' audits say about the feed.

    Files have no offsets: the source declares input rows only; the ranges of the rows
    come from the audits of all micro-batches.
    """
    job = _job(spark, sf, ["regs"], "progress-log")
    src = work_folder(spark, "progress-src")
    dt.game_event_lines(spark, sf, ["sessions", "regs"]).repartition(6, "offset").write.parquet(src)
    q = run_stream(spark, job, {"format": "parquet", "path": src}, name="progress", available_now=True,
                   checkpoint=f"{job.store.root}/_checkpoint", max_per_trigger=2)
    q.awaitTermination()
    declared = spark.createDataFrame(source_ranges(q.recentProgress), RANGES)
    seen = [(r["topic"], r["partition"], r["from_offset"], r["until_offset"], r["messages"]) for m in job.metrics for r in m["ranges"]]
    seen = spark.createDataFrame(seen, "topic string, partition int, from_offset long, until_offset long, messages long")
    ranges = seen.groupBy("topic", "partition").agg(F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset"),
                                                    F.sum("messages").alias("messages"))
    total = declared.agg(F.sum("messages").alias("declared_rows"), F.count("from_offset").alias("declared_ranges"))
    return ranges.crossJoin(total)  # one row of totals


def s9_document_counts(spark, sf):
    """Documents by kind, rows that make none, and dimension lines read and discarded, as
    observed while a batch is written and the dimensions are loaded."""
    pipelines = ["sessions", "deposits", "set_level", "progress"]
    job = _job(spark, sf, pipelines, "counts")
    process_batch(job, dt.game_event_lines(spark, sf, pipelines), 0)
    rows = [("pipeline", p, kind, n) for p, kinds in job.metrics[-1]["documents"].items() for kind, n in kinds.items()]
    for d in ("network", "device", "quest"):
        k, n = catalog.DIM_POSITIONS[d]
        lines = dt.dimension_lines(spark, sf, d)
        # a derived share of the lines is damaged: cut short, or without a name
        odd = F.when(F.length("value") % 5 == 0, F.substring_index("value", "|", 1)).when(
            F.length("value") % 5 == 1, F.regexp_replace("value", r"[^|]+", "")).otherwise(F.col("value"))
        seen = Observation(f"dim-{d}")
        dimension_from_lines(lines.select(odd.alias("value")), d, k, n, seen).write.format("noop").mode("overwrite").save()
        rows += [("dimension", d, kind, seen.get[kind]) for kind in ("lines", "discarded")]
    return spark.createDataFrame(rows, "what string, name string, kind string, n long")


def a2_batch_count(spark, sf):
    """A2: the routed batch's row count, observed while the batch is scanned."""
    from .operators.metrics import observed_count
    routed = route_batch(dt.game_event_lines(spark, sf, ALL), ALL).where(F.col("__event") != "")
    rows, obs = observed_count(routed, "a2")
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(int(obs.get["rows"]),)], "rows long")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "f1_prefilter": f1_prefilter,
    "f3_predicates": f3_predicates,
    "f4_product_action": f4_product_action,
    "p1_datetime": p1_datetime,
    "p2_week": p2_week,
    "p3_month": p3_month,
    "p4_day": p4_day,
    "p5_doc_id": p5_doc_id,
    "p9_fill": p9_fill,
    "p10_usd": p10_usd,
    "p12_sparse_map": p12_sparse_map,
    "j1_dims": j1_dims,
    "j2_rates": j2_rates,
    "a1_max": a1_max,
    "l1_latest_ties": l1_latest_ties,
    "l1_latest_one": l1_latest_one,
    "s2_archive_range": s2_archive_range,
    "s3_dim_load": s3_dim_load,
    "s4_rates_explode": s4_rates_explode,
    "s5_daily_rates": s5_daily_rates,
    "s5_daily_usd": s5_daily_usd,
    "s6_latest_rates": s6_latest_rates,
    "s6_rates_refresh": s6_rates_refresh,
    "s7_parse": s7_parse,
    "s7_dead_letters": s7_dead_letters,
    "s9_offset_audit": s9_offset_audit,
    "s9_batch_metrics": s9_batch_metrics,
    "s9_stream_progress": s9_stream_progress,
    "s9_document_counts": s9_document_counts,
    "e1_sessions": _pipeline_query("sessions"),
    "e2_deposits": _pipeline_query("deposits"),
    "e3_trigger": _pipeline_query("trigger"),
    "e4_user_game_profile": _pipeline_query("userGameProfile"),
    "e5_profile": _pipeline_query("profile"),
    "e6_regs": _pipeline_query("regs"),
    "e7_set_level": _pipeline_query("set_level"),
    "e8_resources": _pipeline_query("resources"),
    "e9_prod_move": _pipeline_query("prodMove"),
    "e10_battle": _pipeline_query("battle"),
    "e11_progress": _pipeline_query("progress"),
    "k1_merge": k1_merge,
    "k2_append": k2_append,
    "k3_partitioned": k3_partitioned,
    "k4_player360": k4_player360,
    "t1_stream_equals_batch": t1_stream_equals_batch,
    "t4_backfill": t4_backfill,
    "t4_backfill_resume": t4_backfill_resume,
    "t5_backfill_back": t5_backfill_back,
    "t3_shared_batch": t3_shared_batch,
    "t5_late_replay": t5_late_replay,
    "t5_two_jobs": t5_two_jobs,
    "a2_batch_count": a2_batch_count,
}


def _configured(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ensure_utc(spark)
        return fn(spark, sf)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES = {name: _configured(fn) for name, fn in QUERIES.items()}
