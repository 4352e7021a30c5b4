"""Stream and backfill share process_batch and give the same documents."""

import json

from playerledger.session import list_paths
from playerledger.sinks import DocumentStore
from playerledger.streaming import Job, dead_letters, numbers_done, process_batch, run_backfill, run_stream

from .helpers import dims


def _events(n=40):
    out = []
    for i in range(n):
        name = ["CONNECT", "LOGIN", "DISCONNECT", "USER_PROFILE"][i % 4]
        out.append({"cluster_id": "c", "player_id": f"p{i % 5}", "session_id": f"s{i % 3}", "network_id": i % 2,
                    "event_name": name, "event_ts": 1_700_000_000_000 + i * 1000, "email": f"e{i}"})
    return out


def test_stream_equals_backfill(spark, tmp_dir):
    pipelines = ["sessions", "resources", "profile"]
    d = dims(spark, pipelines, {"network": ["0|zero", "1|one"]})
    lines = [json.dumps(e) for e in _events()] + ["not json"]
    # archive: numbered folders 1..4; the stream reads the same lines as files
    for n in range(4):
        spark.createDataFrame([(v,) for v in lines[n::4]], "value string").coalesce(1).write.text(
            f"{tmp_dir}/arch/archive_no={n + 1}")
        spark.createDataFrame([(v,) for v in lines[n::4]], "value string").coalesce(1).write.text(
            f"{tmp_dir}/stream/part{n}")

    batch_store = DocumentStore(spark, tmp_dir + "/batch")
    run_backfill(spark, Job(pipelines, d, batch_store), tmp_dir + "/arch", 1, 4, slice_size=4)

    stream_store = DocumentStore(spark, tmp_dir + "/streamed")
    q = run_stream(spark, Job(pipelines, d, stream_store), {"format": "text", "path": tmp_dir + "/stream/*"},
                   name="t", available_now=True, checkpoint=tmp_dir + "/ckpt", max_per_trigger=1)
    q.awaitTermination()

    # the same slice again, and a second backfill of one number, change nothing but what they bring
    run_backfill(spark, Job(pipelines, d, batch_store), tmp_dir + "/arch", 1, 4, slice_size=4)
    for table in ("sessions", "resources", "player_profile"):
        a = sorted(map(tuple, batch_store.table(table).documents().collect()))
        b = sorted(map(tuple, stream_store.table(table).documents().collect()))
        assert a == b and len(a) > 0


def test_dead_letters_and_rejects(spark, tmp_dir):
    pipelines = ["regs"]
    d = dims(spark, pipelines)
    events = [{"event_name": "REGISTRATION", "event_ts": 5, "cluster_id": "c", "player_id": None,
               "login_source_id": "x"},
              {"event_name": "REGISTRATION", "event_ts": 6, "cluster_id": "c", "player_id": "p",
               "login_source_id": "y"}]
    # a numeric event name reads as the unknown name "7": filtered like any unwanted event
    lines = [json.dumps(e) for e in events] + ["{broken", '{"x": 1}', '{"event_name": 7}']
    raw = spark.createDataFrame([(v,) for v in lines], "value string")
    store = DocumentStore(spark, tmp_dir + "/s")
    job = Job(pipelines, d, store)
    process_batch(job, raw, 0)
    (m,) = job.metrics
    assert (m["batch_id"], m["rows"], m["messages"], m["dead_letters"]) == (0, 2, 5, 2)
    assert sorted(r.value for r in dead_letters(store).collect()) == sorted(["{broken", '{"x": 1}'])
    t = store.table("player_profile")
    assert [r.login_source_id for r in t.rejects().collect()] == ["x"]
    assert [(r.id, r.login_source_id) for r in t.documents().collect()] == [("p_c", "y")]


def test_present_wins_policy(spark, tmp_dir):
    """A later CONNECT whose country is unknown blanks the name only under present_wins."""
    pipelines = ["sessions"]
    d = dims(spark, pipelines, {"country": ["7|Neverland"]})
    base = {"cluster_id": "c", "player_id": "p", "session_id": "s", "network_id": 1, "event_name": "CONNECT"}
    first = spark.createDataFrame([(json.dumps({**base, "event_ts": 1000, "login_country_id": "7"}),)], "value string")
    later = spark.createDataFrame([(json.dumps({**base, "event_ts": 2000, "login_country_id": "8"}),)], "value string")
    got = {}
    for policy in ("skip_nulls", "present_wins"):
        store = DocumentStore(spark, f"{tmp_dir}/{policy}", null_policy=policy)
        job = Job(pipelines, d, store, with_present=True)
        process_batch(job, first, 0)
        process_batch(job, later, 1)
        doc = store.table("sessions").documents().first()
        got[policy] = (doc.login_country_id, doc.country_name)
    assert got == {"skip_nulls": ("8", "Neverland"), "present_wins": ("8", None)}


def _raw(spark, events):
    return spark.createDataFrame([(e if isinstance(e, str) else json.dumps(e),) for e in events], "value string")


def test_wrongly_typed_lines_are_dead_letters(spark, tmp_dir):
    store = DocumentStore(spark, tmp_dir)
    job = Job(["regs", "sessions"], dims(spark, ["regs", "sessions"]), store)
    reg = {"event_name": "REGISTRATION", "cluster_id": "c", "player_id": "p", "event_ts": 5}
    con = {"event_name": "CONNECT", "cluster_id": "c", "player_id": "p", "session_id": "s", "event_ts": 1_700_000_000_000}
    bad = [{**reg, "network_id": "seven"}, {**con, "event_ts": "now"}, "{broken"]
    process_batch(job, _raw(spark, [reg, con, *bad, {**con, "event_ts": None}]), 0)
    got = {(r.pipeline, r.value) for r in dead_letters(store).collect()}
    assert got == {("regs", json.dumps(bad[0])), ("sessions", json.dumps(bad[1])), (None, "{broken")}
    assert job.metrics[0]["dead_letters"] == 3
    assert [r.player_id for r in store.table("sessions").documents().collect()] == ["p"]
    # an event without a time has no week: rejected, not filed under a catch-all
    assert store.table("sessions").rejects().count() == 1
    assert [r.date_part for r in store.table("sessions").documents().collect()] == ["2023_46"]


def test_sparse_profile_fields_merge_one_by_one(spark, tmp_dir):
    store = DocumentStore(spark, tmp_dir)
    job = Job(["userGameProfile"], {}, store)
    base = {"event_name": "USER_GAME_PROFILE", "cluster_id": "c", "player_id": "p"}
    process_batch(job, _raw(spark, [{**base, "event_ts": 1, "base_name": "b", "is_vip": 1}]), 0)
    process_batch(job, _raw(spark, [{**base, "event_ts": 2, "user_name": "u"}]), 1)
    for _ in range(2):
        doc = store.table("player_profile").documents().first()
        assert (doc.base_name, doc.is_vip, doc.user_name, doc.player_id) == ("b", "1", "u", "p")
        job.compact()


def test_append_mode_game_name_and_file_size(spark, tmp_dir):
    store = DocumentStore(spark, tmp_dir)
    job = Job(["battle"], dims(spark, ["battle"]), store, mode={"battle": "append"}, game="arena", max_records_per_file=2)
    base = {"event_name": "BATTLE", "cluster_id": "c", "player_id": "p", "session_id": "s", "event_ts": 1_700_000_000_000}
    process_batch(job, _raw(spark, [{**base, "battle_id": str(i % 3)} for i in range(5)]), 0)
    docs = job.table("battle").appended()
    assert docs.count() == 5 and "write_rank" not in docs.columns and len(docs.inputFiles()) >= 3
    assert all("/arena_battle/append/" in f for f in docs.inputFiles())
    assert job.table("battle").documents() is None


def test_streams_with_new_checkpoints_do_not_overwrite(spark, tmp_dir):
    store = DocumentStore(spark, tmp_dir + "/store")
    job = Job(["regs"], dims(spark, ["regs"]), store, compact_every=1)
    for k in range(2):
        reg = {"event_name": "REGISTRATION", "cluster_id": "c", "player_id": f"p{k}", "event_ts": 5 + k}
        _raw(spark, [reg]).coalesce(1).write.text(f"{tmp_dir}/in{k}")
        q = run_stream(spark, job, {"format": "text", "path": f"{tmp_dir}/in{k}"}, name=f"s{k}", available_now=True,
                       checkpoint=f"{tmp_dir}/ckpt{k}")
        q.awaitTermination()
    assert [m["batch_id"] for m in job.metrics] == [0, 0]
    assert sorted(r.player_id for r in store.table("player_profile").documents().collect()) == ["p0", "p1"]


def test_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    import pytest

    from playerledger.session import checkpoint_root
    sc = SimpleNamespace(master="spark://host:7077", getConf=lambda: {}, getCheckpointDir=lambda: None)
    with pytest.raises(ValueError):
        checkpoint_root(SimpleNamespace(sparkContext=sc))


def _archive(spark, root, players):
    for n, player in players.items():
        reg = {"event_name": "REGISTRATION", "cluster_id": "c", "player_id": player, "event_ts": 1000 + n}
        _raw(spark, [reg]).coalesce(1).write.mode("overwrite").text(f"{root}/archive_no={n}")


def test_backfill_of_an_earlier_range(spark, tmp_dir):
    store = DocumentStore(spark, tmp_dir + "/store")
    job = Job(["regs"], dims(spark, ["regs"]), store)
    _archive(spark, tmp_dir + "/arch", {n: f"p{n}" for n in (1, 2, 3, 10, 11, 12)})
    run_backfill(spark, job, tmp_dir + "/arch", 10, 12)
    job.compact()
    run_backfill(spark, job, tmp_dir + "/arch", 1, 3)
    for _ in range(2):
        assert sorted(r.player_id for r in job.table("regs").documents().collect()) == ["p1", "p10", "p11", "p12", "p2", "p3"]
        job.compact()


def test_backfill_in_other_slices_stores_nothing_twice(spark, tmp_dir):
    _archive(spark, tmp_dir + "/arch", {n: f"p{n}" for n in range(1, 5)})
    for mode in ("append", "update"):
        job = Job(["regs"], dims(spark, ["regs"]), DocumentStore(spark, f"{tmp_dir}/{mode}"), mode=mode)
        for size in (1, 4, 3):
            run_backfill(spark, job, tmp_dir + "/arch", 1, 4, slice_size=size)
            t = job.table("regs")
            got = t.appended() if mode == "append" else t.documents()
            assert sorted(r.player_id for r in got.collect()) == ["p1", "p2", "p3", "p4"]
        assert {b[2] for b in t.written("append" if mode == "append" else "changes")} == {1, 2, 3, 4}
        # a number whose content changed, in a slice with others
        _archive(spark, tmp_dir + "/arch", {2: "q2"})
        run_backfill(spark, job, tmp_dir + "/arch", 1, 4, slice_size=2)
        got = t.appended() if mode == "append" else t.documents()
        assert sorted(r.player_id for r in got.collect()) == ["p1", "p3", "p4", "q2"]
        _archive(spark, tmp_dir + "/arch", {2: "p2"})


def test_backfill_resumes_and_forgets_empty_numbers(spark, tmp_dir):
    job = Job(["regs"], dims(spark, ["regs"]), DocumentStore(spark, tmp_dir + "/s"), mode="append")
    _archive(spark, tmp_dir + "/arch", {1: "p1", 2: "p2"})
    run_backfill(spark, job, tmp_dir + "/arch", 1, 4, slice_size=2)
    assert numbers_done(job, "job-backfill") == {1, 2}
    _archive(spark, tmp_dir + "/arch", {2: "changed", 3: "p3"})
    run_backfill(spark, job, tmp_dir + "/arch", 1, 4, slice_size=4, resume=True)
    assert sorted(r.player_id for r in job.table("regs").appended().collect()) == ["p1", "p2", "p3"]
    assert [m["batch_id"] for m in job.metrics] == [1, 3]
    # numbers without any event of the pipeline any more, alone and among others
    other = {"event_name": "CONNECT", "cluster_id": "c", "player_id": "x", "session_id": "s", "event_ts": 5}
    for n in (1, 3):
        _raw(spark, [other]).coalesce(1).write.mode("overwrite").text(f"{tmp_dir}/arch/archive_no={n}")
    run_backfill(spark, job, tmp_dir + "/arch", 1, 1)
    run_backfill(spark, job, tmp_dir + "/arch", 2, 3, slice_size=2)
    assert sorted(r.player_id for r in job.table("regs").appended().collect()) == ["changed"]


def test_latest_per_player_in_each_archive_number(spark, tmp_dir):
    """Slices of any size give the same documents, also where only the newest event of a batch counts."""
    base = {"event_name": "USER_PROFILE", "cluster_id": "c", "player_id": "p"}
    for n, more in ((1, {"email": "e1", "event_ts": 10}), (2, {"first_name": "f2", "event_ts": 20})):
        _raw(spark, [{**base, **more}]).coalesce(1).write.text(f"{tmp_dir}/arch/archive_no={n}")
    got = []
    for size in (1, 2):
        job = Job(["profile"], dims(spark, ["profile"]), DocumentStore(spark, f"{tmp_dir}/{size}"))
        run_backfill(spark, job, tmp_dir + "/arch", 1, 2, slice_size=size)
        got.append([(r.email, r.first_name) for r in job.table("profile").documents().collect()])
    assert got == [[("e1", "f2")]] * 2


def test_an_empty_batch_writes_nothing(spark, tmp_dir):
    store = DocumentStore(spark, tmp_dir + "/s")
    job = Job(["regs", "sessions"], dims(spark, ["regs", "sessions"]), store)
    process_batch(job, spark.createDataFrame([], "value string"), 0)
    assert list_paths(spark, tmp_dir + "/s/*") == [] and dead_letters(store).count() == 0
    assert (job.metrics[0]["rows"], job.metrics[0]["messages"], job.metrics[0]["documents"]) == (0, 0, {})
    assert job.table("regs").documents() is None


def test_rows_that_make_no_document_are_counted(spark, tmp_dir):
    job = Job(["deposits"], dims(spark, ["deposits"]), DocumentStore(spark, tmp_dir))
    base = {"cluster_id": "c", "player_id": "p", "event_ts": 1_700_000_000_000, "session_id": "s"}
    events = [{**base, "event_name": "SEND_TRANSACTION", "internal_transaction_id": "t1"}]
    events += [{**base, "event_name": "TRANSACTION_RESULT", "internal_transaction_id": f"t{i}", "transaction_status_id": s}
               for i, s in enumerate((1, None, 2, 9, 9, 77))]
    process_batch(job, _raw(spark, events), 0)
    assert job.metrics[0]["documents"] == {"deposits": {
        "no_document": 3, "send": 1, "approved": 2, "refused": 1, "canceled": 0, "pending": 0, "error": 0}}


def test_files_have_no_offsets(spark, tmp_dir):
    job = Job(["regs"], dims(spark, ["regs"]), DocumentStore(spark, tmp_dir))
    reg = {"event_name": "REGISTRATION", "cluster_id": "c", "player_id": "p", "event_ts": 5}
    process_batch(job, _raw(spark, [reg, {**reg, "player_id": "q"}]), 0)
    (r,) = job.metrics[0]["ranges"]
    assert (r["topic"], r["partition"], r["from_offset"], r["until_offset"], r["messages"]) == (None, None, None, None, 2)


def test_deposits_by_the_rate_of_their_day(spark, tmp_dir):
    from playerledger.sources import daily_currency_rates, store_daily_rates
    lines = spark.createDataFrame([("20231114|EUR|x|0.5",), ("20231115|EUR|x|0.25",)], "value string")
    store_daily_rates(daily_currency_rates(lines), tmp_dir + "/rates")
    job = Job(["deposits"], dims(spark, ["deposits"]), DocumentStore(spark, tmp_dir + "/s"), daily_rates=tmp_dir + "/rates")
    base = {"event_name": "SEND_TRANSACTION", "cluster_id": "c", "player_id": "p", "deposit_amount": 1.0, "deposit_currency": "EUR"}
    day = 86_400_000
    events = [{**base, "event_ts": 1_700_000_000_000 + n * day, "internal_transaction_id": str(n)} for n in range(3)]
    process_batch(job, _raw(spark, events), 0)
    docs = job.table("deposits").documents().orderBy("internal_transaction_id").collect()
    assert [d.usd_deposit for d in docs] == [2.0, 4.0, None]
