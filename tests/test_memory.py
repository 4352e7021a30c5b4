"""What executors hold at a time must not grow with a batch: lines on disk in small pieces, files and broadcasts of bounded size."""

import datetime
import json
import os

import pytest

from playerledger import driver_tables as dt
from playerledger import queries
from playerledger.operators.broadcast import checked_broadcast
from playerledger.sinks import DocumentStore
from playerledger.streaming import batch
from playerledger.streaming.batch import Job, process_batch

from .helpers import dims


def _battles(n):
    return [(json.dumps({"event_name": "BATTLE", "player_id": f"p{i % 7}", "cluster_id": "1", "session_id": "s", "battle_id": f"b{i}",
                         "event_ts": 1_700_000_000_000 + i}), "t", 0, i) for i in range(n)]


@pytest.mark.parametrize("mode", ["update", "append"])
def test_a_batch_s_lines_take_no_storage_memory(spark, tmp_dir, monkeypatch, mode):
    """serialized blocks of lines filled the executors' heap, twice what Spark counted for them."""
    kept, persist = [], type(spark.range(1)).persist
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda df, *a: kept.append(df) or persist(df, *a))
    held, audit = [], batch.offset_audit

    def stored():
        return {r.id(): (r.memSize(), r.diskSize() > 0) for r in spark.sparkContext._jsc.sc().getRDDStorageInfo()}

    def seen(lines, **k):
        (cached,) = [df for df in kept if "__event" in df.columns]
        before = stored()
        cached.count()
        held.append((cached.storageLevel, [v for n, v in stored().items() if n not in before]))
        return audit(lines, **k)
    monkeypatch.setattr(batch, "offset_audit", seen)
    raw = spark.createDataFrame(_battles(300), "value string, topic string, partition int, offset long")
    job = Job(["battle"], dims(spark, ["battle"]), DocumentStore(spark, tmp_dir), mode=mode)
    process_batch(job, raw, 0)
    ((level, blocks),) = held
    assert not level.useMemory and level.useDisk and blocks == [(0, True)]
    table = job.table("battle")
    docs = table.documents() if mode == "update" else table.appended()
    assert docs.count() == 300 and docs.select("battle_id").distinct().count() == 300


def test_cached_lines_are_read_in_small_batches(spark, tmp_dir, monkeypatch):
    """a task reading a block back held a hundred batches of 4 MB."""
    key = "spark.sql.inMemoryColumnarStorage.batchSize"
    before, rows, audit = spark.conf.get(key), [], batch.offset_audit

    def seen(lines, **k):
        rows.append(int(spark.conf.get(key)))
        return audit(lines, **k)
    monkeypatch.setattr(batch, "offset_audit", seen)
    raw = spark.createDataFrame(_battles(1200), "value string, topic string, partition int, offset long").coalesce(1)
    job = Job(["battle"], dims(spark, ["battle"]), DocumentStore(spark, tmp_dir))
    process_batch(job, raw, 0)
    assert rows[0] <= 1000 < int(before) and spark.conf.get(key) == before
    assert job.metrics[0]["rows"] == 1200 and job.table("battle").documents().count() == 1200


def _feed_tables(spark, path):
    at = datetime.datetime(2024, 1, 1)
    types = list(dt.EVENT_FANOUT)
    ev = [(i, at, i % 40, types[i % len(types)], float(i), json.dumps({"k": i % 13})) for i in range(200)]
    od = [(i, i % 40, "O", 10.0, at, "1-URGENT") for i in range(60)]
    li = [(i % 60, i % 9, i % 40, 1 + i // 60, 2.0, 3.0, 0.0, 0.0, "N", "O", at) for i in range(120)]
    for name, some, columns in (
            ("events", ev, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
            ("orders", od, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
            ("lineitem", li, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                             "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")):
        spark.createDataFrame(some, columns).coalesce(1).write.parquet(f"{path}/{name}.parquet")


@pytest.mark.parametrize("size", [1 << 20, 512])
def test_files_of_a_stream_follow_the_tables(spark, tmp_dir, monkeypatch, size):
    """the stream's source was as few files as the session has shuffle parts, whatever the tables' size."""
    _feed_tables(spark, tmp_dir)
    monkeypatch.setattr(dt, "BYTES_A_FILE", size)
    monkeypatch.setattr(queries, "_dims", lambda *a: {})
    monkeypatch.setattr(queries, "_all_contents", lambda job: None)
    asked = {}

    class Ended:
        def awaitTermination(self):
            return None

    def stream(spark, job, source, max_per_trigger=None, **k):
        asked.update(path=source["path"], n=max_per_trigger)
        return Ended()
    monkeypatch.setattr(queries, "run_stream", stream)
    queries.t1_stream_equals_batch(spark, tmp_dir)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-sum(os.path.getsize(f"{d}/{f}") for t in ("events", "orders", "lineitem") for d in [f"{tmp_dir}/{t}.parquet"]
                    for f in os.listdir(d) if f.endswith(".parquet")) // size)
    source = spark.read.parquet(asked["path"]).selectExpr("*", "get_json_object(value, '$.player_id') AS player", "_metadata.file_name AS file")
    files = source.select("file").distinct().count()
    assert asked["n"] == max(parts, wanted) // 2
    assert files <= parts if wanted <= parts else files > parts
    # a player's lines are in one file, and all lines are there once
    assert source.groupBy("player").agg({"file": "count"}).count() == source.select("player", "file").distinct().count() == 40
    lines = dt.game_event_lines(spark, tmp_dir, queries.ALL)
    assert sorted(map(tuple, source.drop("player", "file").collect())) == sorted(map(tuple, lines.collect()))


def test_broadcasts_are_bounded_by_their_hash_table(spark):
    """a lookup of many short rows passed by its encoded size; its hash table took ten times that."""
    small = spark.range(4000).selectExpr("CAST(id AS STRING) AS k", "'x' AS n").persist()
    try:
        def hinted(most):
            df = checked_broadcast(small, most)
            return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString(), df.count()
        assert hinted(200_000) == (False, 4000)
        assert hinted(2_000_000) == (True, 4000)
    finally:
        small.unpersist()
