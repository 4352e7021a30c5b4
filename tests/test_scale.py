"""Plans whose cost a line must not grow: tasks by input size, one read of a line's name, code that is compiled."""

import datetime
import json
import re

from playerledger import driver_tables as dt
from playerledger import catalog, schema
from playerledger.plans import PLANS, PlanContext
from playerledger.sinks import DocumentStore, doc_table
from playerledger.sources.events import CORRUPT_COLUMN, parse_events, prefilter_event_names
from playerledger.streaming import batch
from playerledger.streaming.batch import Job, pipeline_changes, process_batch, route_batch

from .helpers import dims

#: HotSpot compiles no method above this.
COMPILED = 8000


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _largest_method(spark, df) -> int:
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$").__getattr__("MODULE$")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan has no code before it runs
    try:
        code = debug.codegenString(df.select("*")._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code))


def _events(spark, path, n=500):
    at = datetime.datetime(2024, 1, 1)
    types = list(dt.EVENT_FANOUT)
    rows = [(i, at, i % 9, types[i % len(types)], float(i), json.dumps({"k": i % 13})) for i in range(n)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    df.coalesce(1).write.parquet(f"{path}/events.parquet")


def test_tasks_follow_the_size_of_the_table(spark, tmp_dir, monkeypatch):
    """A table of many bytes and few splits was left at one task a core."""
    _events(spark, tmp_dir)
    size = 64
    monkeypatch.setattr(dt, "BYTES_A_TASK", size)
    monkeypatch.setattr(dt, "_SPLITS", {})
    lines = dt.game_event_lines(spark, tmp_dir, ["sessions"])
    assert lines.rdd.getNumPartitions() > 2 * spark.sparkContext.defaultParallelism
    assert lines.count() == 300


def test_fanout_of_all_event_types(spark, tmp_dir):
    """The lines made in two steps are those of each type alone, and their code is compiled."""
    _events(spark, tmp_dir)
    pipelines = [p for p in catalog.PIPELINE_EVENTS if p not in ("deposits", "prodMove", "battle")]
    lines = dt.game_event_lines(spark, tmp_dir, pipelines)
    got = {}
    for r in lines.collect():
        got.setdefault(json.loads(r.value)["event_name"], set()).add((r.partition, r.offset))
    want = {name: {(slot, i) for i in range(500) if list(dt.EVENT_FANOUT)[i % 5] == t}
            for t, names in dt.EVENT_FANOUT.items() for slot, name in enumerate(names)}
    assert got == want
    assert _largest_method(spark, lines) < COMPILED


def test_a_line_is_read_once_for_its_name(spark):
    """A filter on the name brought two to six more reads of each line."""
    raw = spark.createDataFrame([('{"event_name": "BATTLE"}',), ('{"event_name": "X"}',), ("no",)], "value string")
    routed = route_batch(raw, ["battle"])
    for some in (routed.where("__event != ''"), routed.where("__event = 'BATTLE'")):
        assert _plan(some).count("get_json_object") == 1
        assert some.count() == 1
    named = prefilter_event_names(raw, ["BATTLE"], "name")
    assert _plan(named).count("get_json_object") == 1
    assert [tuple(r) for r in named.collect()] == [('{"event_name": "BATTLE"}', "BATTLE")]
    assert [r.value for r in prefilter_event_names(raw, ["BATTLE"]).collect()] == ['{"event_name": "BATTLE"}']


def test_some_fields_of_lines_checked_for_all(spark):
    """fields that nobody asked for came out of the parse; what is corrupt stays so."""
    lines = ['{"a": 1, "s": "x", "d": 2.5}', '{"a": 1, "s": {"t": [1]}, "d": 2}', '{"a": "one", "s": "x"}',
             '{"a": 1, "d": "much"}', '{"a": 1, "s": 7, "l": 1.5}', "broken", "", '[{"a": 2}]', None, '{"a": 1, "s": "\\q"}', '{"a": 99999999999}']
    raw = spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value string, offset long")
    fields = [("a", "int"), ("s", "string"), ("d", "double"), ("l", "long")]
    shown = ["offset", "a", CORRUPT_COLUMN]
    whole, some = parse_events(raw, fields), parse_events(raw, fields, only=["a"])
    assert some.columns == ["a", CORRUPT_COLUMN, "offset"]
    assert sorted(some.select(shown).collect(), key=str) == sorted(whole.select(shown).collect(), key=str)
    assert '"s"' not in json.dumps(_plan(some)) and "StructField(s," not in _plan(some)


def test_documents_of_deposits_are_compiled(spark):
    """six branches a column made a projection that the JVM runs uncompiled."""
    d = dims(spark, ["deposits"])
    rates = spark.createDataFrame([("EUR", 0.5)], "curr string, us_val double")
    base = {n: "1" for n, k in schema.DEPOSIT if k == "string"} | {"event_ts": 1_700_000_000_000, "deposit_amount": 10.0, "deposit_currency": "EUR"}
    events = [{**base, "event_name": "SEND_TRANSACTION", "original_offer_amount": 3.0}] + [
        {**base, "event_name": "TRANSACTION_RESULT", "transaction_status_id": s} for s in (1, 2, 3, 4, 5, 9, None, -1)]
    raw = spark.createDataFrame([(json.dumps(e),) for e in events], "value string")
    changes = pipeline_changes(raw, "deposits", d, PlanContext(rates=rates, with_present=True))
    got = [(r.write_rank, r.usd_deposit, r.original_offer_amount, bool(r.Approved_status_time), bool(r.error_status_time), len(r.present))
           for r in changes.collect()]
    sizes = [len(k.columns) for k in PLANS["deposits"].kinds()]
    assert got == [(1, 20.0, 3.0, False, False, sizes[0]), (2, 20.0, None, True, False, sizes[1]),
                   *[(s + 1, None, None, False, s == 5, sizes[s]) for s in (2, 3, 4, 5)],
                   *[(2, 20.0, None, True, False, sizes[1])] * 2]
    assert _largest_method(spark, changes) < COMPILED


def test_merging_tasks_follow_the_rows(spark, tmp_dir, monkeypatch):
    """a merge of any size was dealt to the session's number of tasks."""
    rows = spark.range(300).selectExpr("'1998-01' AS date_part", "CAST(id % 100 AS STRING) AS id", "CAST(id AS STRING) AS v",
                                       "1 AS write_rank", "named_struct('ts', id, 'partition', 0, 'offset', id) AS __src")
    table = doc_table.DocumentTable(spark, tmp_dir, "t")
    table.write_changes(rows, "once", 0, "s")
    before = sorted(map(tuple, table.documents().collect()))
    monkeypatch.setattr(doc_table, "ROWS_A_TASK", 3)
    assert table.documents().rdd.getNumPartitions() == 100
    assert sorted(map(tuple, table.documents().collect())) == before and len(before) == 100
    table.compact()
    assert sorted(map(tuple, table.documents().collect())) == before


def test_buckets_follow_the_events(spark, tmp_dir, monkeypatch):
    """a table without a date split was merged by eight tasks at any size."""
    from playerledger import queries
    _events(spark, tmp_dir)
    monkeypatch.setattr(queries, "_dims", lambda *a: {})
    assert queries._job(spark, tmp_dir, [], "b").store.buckets == 8
    monkeypatch.setattr(dt, "BYTES_A_TASK", 64)
    assert queries._job(spark, tmp_dir, [], "b").store.buckets > 8


def test_a_batch_without_rates_reads_no_time_of_its_lines(spark, tmp_dir, monkeypatch):
    """the audit read each line once more for a time that only rates go by,
    and the cache tried encodings on lines that all differ."""
    key = "spark.sql.inMemoryColumnarStorage.compressed"
    audits, audit = [], batch.offset_audit

    def seen(*a, **k):
        out = audit(*a, **k)
        audits.append((_plan(out).count("$.event_ts"), spark.conf.get(key)))
        return out
    monkeypatch.setattr(batch, "offset_audit", seen)
    asked, before = [], spark.conf.get(key)

    def rates(at):
        asked.append(at)
        return spark.createDataFrame([("EUR", 0.5)], "curr string, us_val double")
    line = {"cluster_id": "c", "player_id": "p", "session_id": "s", "internal_transaction_id": "1"}
    raw = spark.createDataFrame([(json.dumps({**line, "event_name": n, "event_ts": t}),) for n, t in (
        ("SEND_TRANSACTION", 1_700_000_000_000), ("TRANSACTION_RESULT", 1_700_000_009_000), ("CONNECT", 1_700_000_005_000),
        ("CONNECT", None), ("BATTLE", 1_800_000_000_000))], "value string")
    got = []
    for k, (pipelines, more, at) in enumerate(((["deposits", "sessions"], {}, None), (["sessions"], {"rates": rates}, None),
                                               (["deposits"], {"rates": rates}, None), (["deposits"], {"rates": rates}, 7), (["regs"], {}, None))):
        job = Job(pipelines, dims(spark, pipelines), DocumentStore(spark, f"{tmp_dir}/{k}"), **more)
        process_batch(job, raw, 0, at)
        (m,) = job.metrics
        got.append((m["rows"], m["newest"], sum(m["documents"][p]["no_document"] for p in m["documents"])))
    assert [n for n, _ in audits] == [0, 0, 1, 0, 0]
    assert {c for _, c in audits} == {"false"} and spark.conf.get(key) == before
    assert asked == [1_700_000_009_000, 7]
    assert got == [(4, 1_700_000_009_000, 0), (2, 1_700_000_005_000, 0), (2, 1_700_000_009_000, 0), (2, 1_700_000_009_000, 0), (0, None, 0)]


def _changes(spark, rows):
    return spark.createDataFrame([(d, i, a, 1, (t, 0, t)) for t, (d, i, a) in enumerate(rows)],
                                 "date_part string, id string, a string, write_rank int, __src struct<ts:long,partition:int,offset:long>")


def test_new_batches_are_not_joined_to_the_ledger(spark, tmp_dir, monkeypatch):
    """all change rows were shuffled to leave out what the parts hold, though none held any of their batches."""
    t = doc_table.DocumentTable(spark, tmp_dir, "docs", ["s"])
    t.write_changes(_changes(spark, [("1", "d", "x"), ("2", "e", "x")]), "j", 0, "s")
    t.compact()
    t.write_changes(_changes(spark, [("1", "d", "y"), ("2", "f", "y"), (None, "g", "y"), ("2", None, "y")]), "j", 1, "s")
    pending = t.pending()
    assert "Join" not in _plan(pending) and pending.count() == 4
    # a key's rows are of one part: parts of few rows need no count by key
    monkeypatch.setattr(doc_table, "measured_keys", None)
    monkeypatch.setattr(doc_table, "hot_keys", None)
    want = [("d", "x"), ("d", "y"), ("e", "x"), ("f", "y")]
    for _ in range(2):
        assert sorted((r.id, r.a) for r in t.documents().collect()) == want[1:]
        t.compact()
    assert sorted((r.date_part, r.batch_id) for r in t.ledger().collect()) == [("1", 0), ("1", 1), ("2", 0), ("2", 1)]


def test_hot_keys_are_sought_in_large_parts(spark, tmp_dir, monkeypatch):
    """a hot key of a large part is still folded in pieces."""
    monkeypatch.setattr(doc_table, "HOT_ROWS", 20)
    monkeypatch.setattr(doc_table, "measured_keys", None)
    found, seek = [], doc_table.hot_keys
    monkeypatch.setattr(doc_table, "hot_keys", lambda *a, **k: found.append(seek(*a, **k)) or found[-1])
    t = doc_table.DocumentTable(spark, tmp_dir, "docs", ["s"])
    t.write_changes(_changes(spark, [("1", "hot", f"v{i:03}") for i in range(30)] + [("1", "d", "x"), ("2", "e", "x")]), "j", 0, "s")
    want = [("1", "d", "x"), ("1", "hot", "v029"), ("2", "e", "x")]
    for _ in range(2):
        assert sorted((r.date_part, r.id, r.a) for r in t.documents().collect()) == want
        t.compact()
    assert [[tuple(r) for r in f.collect()] for f in found] == [[("1", "hot")]] * 2


def test_events_that_make_no_line_are_not_spread(spark, tmp_dir, monkeypatch):
    """rows of all event types were shuffled and read for the lines of two."""
    _events(spark, tmp_dir)
    monkeypatch.setattr(dt, "_SPLITS", {})
    lines = dt.game_event_lines(spark, tmp_dir, ["progress"])
    plan = _plan(lines)
    assert plan.index("RepartitionByExpression") < plan.index("event_type#", plan.index("Filter")) and lines.count() == 200


def test_unwanted_lines_are_kept_small(spark, tmp_dir, monkeypatch):
    """every line, wanted or not, was cached with its position and its batch's number."""
    kept, persist = [], type(spark.range(1)).persist
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda df, *a: kept.append(df.columns) or persist(df, *a))
    lines = [json.dumps({"event_name": "REGISTRATION", "player_id": "p", "cluster_id": "1", "event_ts": 1}), "damaged"]
    raw = spark.createDataFrame([(v, None, None, None) for v in lines], "value string, topic string, partition int, offset long")
    job = Job(pipelines=["regs"], dims=dims(spark, ["regs"]), store=DocumentStore(spark, tmp_dir))
    process_batch(job, raw, 3)
    assert ["value", "topic", "partition", "offset", "__event"] in kept
    where = route_batch(raw, ["regs"]).where("__event IS NOT NULL").first()["__pos"]
    assert [r["seq"]["offset"] for r in job.table("regs").change_rows().collect()] == [where]
    assert job.metrics[0]["dead_letters"] == 1 and [r.batch_id for r in spark.read.parquet(f"{tmp_dir}/_dead_letters/job=job").collect()] == [3]
