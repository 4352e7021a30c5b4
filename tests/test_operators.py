"""J1, L1, A1, K1 (merge / compaction / replay), K4."""

from pyspark.sql import functions as F

from playerledger.operators import (add_event_columns, enrich_with_dims, hot_keys, latest_per_key, max_per_key,
                                    merge_documents)
from playerledger.session import list_paths
from playerledger.sinks import DocumentTable

from .helpers import dims


def test_enrich_int_fact_key_and_unmatched(spark):
    facts = spark.createDataFrame([(1, "c1"), (2, "c9"), (None, "c1")], "network_id int, cluster_id string")
    d = dims(spark, ["profile"], {"network": ["1|net-one", "1|net-a", "x|bad", ""], "cluster": ["c1|Cluster 1"]})
    got = {(r.network_id, r.cluster_id): (r.network_name, r.cluster_name)
           for r in enrich_with_dims(facts, d).collect()}
    assert got == {(1, "c1"): ("net-a", "Cluster 1"), (2, "c9"): (None, None), (None, "c1"): (None, "Cluster 1")}


def test_latest_keeps_ties_and_skips_nulls(spark):
    df = spark.createDataFrame(
        [("p", "c", 10, 1), ("p", "c", 20, 2), ("p", "c", 20, 3), (None, "c", 99, 4), ("q", None, 99, 5),
         ("r", "c", None, 6), ("r", "c", 1, 7)],
        "player_id string, cluster_id string, event_ts long, o long")
    ties = sorted(r.o for r in latest_per_key(df, ["player_id", "cluster_id"]).collect())
    assert ties == [2, 3, 7]
    one = sorted(r.o for r in latest_per_key(df, ["player_id", "cluster_id"], ties=False, tiebreak=["o"]).collect())
    assert one == [3, 7]
    mx = {r.player_id: r.max_ts for r in max_per_key(df.where("player_id = 'p'"), ["player_id", "cluster_id"]).collect()}
    assert mx == {"p": 20}


def _changes(spark, rows):
    df = spark.createDataFrame(rows, "id string, date_part string, a string, b int, ts long, rank int, off long")
    return df.select("id", "date_part", "a", "b",
                     F.struct(F.col("ts").alias("t"), F.col("rank"), F.lit(0).alias("partition"),
                              F.col("off").alias("offset")).alias("seq"))


def test_merge_null_never_overwrites(spark):
    ch = _changes(spark, [("d", "w", "x", 1, 10, 1, 0), ("d", "w", None, 2, 20, 1, 1), ("d", "w", "z", None, 5, 1, 2),
                          (None, "w", "q", 9, 99, 1, 3)])
    got = merge_documents(ch).collect()
    assert [(r.id, r.a, r.b) for r in got] == [("d", "x", 2)]


def test_merge_present_wins(spark):
    ch = _changes(spark, [("d", "w", "x", 1, 10, 1, 0), ("d", "w", None, 2, 20, 1, 1)])
    ch = ch.withColumn("present", F.array(F.lit("a"), F.lit("b")))
    r = merge_documents(ch, null_policy="present_wins").first()
    assert (r.a, r.b) == (None, 2)


def _event_changes(spark, rows):
    df = spark.createDataFrame(rows, "id string, a string, event_ts long, write_rank int, offset long")
    df = df.withColumn("partition", F.lit(0)).withColumn("date_part", F.lit("w"))
    return add_event_columns(df).drop("event_datetime", "event_ts", "partition", "offset")


def test_compaction_keeps_per_field_order(spark, tmp_dir):
    """(ts 10, a='x'), (ts 20, a=null), compact, late (ts 15, a='y') -> a = 'y'."""
    t = DocumentTable(spark, tmp_dir, "docs", ["s"])
    t.write_changes(_event_changes(spark, [("d", "x", 10, 1, 0)]), "j", 0, "s")
    t.write_changes(_event_changes(spark, [("d", None, 20, 1, 1)]), "j", 1, "s")
    t.compact()
    t.write_changes(_event_changes(spark, [("d", "y", 15, 1, 2)]), "j", 2, "s")
    assert [(r.id, r.a) for r in t.documents().collect()] == [("d", "y")]


def test_replayed_batch_is_idempotent(spark, tmp_dir):
    t = DocumentTable(spark, tmp_dir, "docs", ["s"])
    b0 = _event_changes(spark, [("d", "x", 10, 1, 0), ("e", "u", 11, 1, 1)])
    t.write_changes(b0, "j", 0, "s")
    t.write_changes(_event_changes(spark, [("d", "z", 30, 1, 2)]), "j", 1, "s")
    before = sorted(tuple(r) for r in t.documents().collect())
    t.write_changes(b0, "j", 0, "s")  # replay
    assert sorted(tuple(r) for r in t.documents().collect()) == before == [("w", "d", "z"), ("w", "e", "u")]


def test_late_batch_does_not_overwrite_newer(spark, tmp_dir):
    t = DocumentTable(spark, tmp_dir, "docs", ["s"])
    t.write_changes(_event_changes(spark, [("d", "new", 20, 1, 0)]), "j", 0, "s")
    t.write_changes(_event_changes(spark, [("d", "old", 10, 1, 1)]), "j", 1, "s")
    assert t.documents().first().a == "new"
    # parity mode: the order is fixed when a change is written; the last batch wins
    arrival = DocumentTable(spark, tmp_dir + "/arrival", "docs", ["s"], order="arrival")
    arrival.write_changes(_event_changes(spark, [("d", "new", 20, 1, 0)]), "j", 0, "s")
    arrival.write_changes(_event_changes(spark, [("d", "old", 10, 1, 1)]), "j", 1, "s")
    assert arrival.documents().first().a == "old"


def test_merge_independent_of_batch_split(spark, tmp_dir):
    rows = [("d", "a", 10, 1, 0), ("d", None, 12, 1, 1), ("d", "b", 11, 1, 2), ("e", "c", 5, 1, 3)]
    one = DocumentTable(spark, tmp_dir + "/one", "docs", ["s"])
    one.write_changes(_event_changes(spark, rows), "j", 0, "s")
    many = DocumentTable(spark, tmp_dir + "/many", "docs", ["s"])
    for i, r in enumerate(reversed(rows)):
        many.write_changes(_event_changes(spark, [r]), "j", i, "s")
        if i == 1:
            many.compact()
    assert sorted(tuple(r) for r in one.documents().collect()) == sorted(tuple(r) for r in many.documents().collect())


def test_jobs_do_not_hide_each_others_changes(spark, tmp_dir):
    """Job one is compacted at its batch 3; job two's batches 0 and 1 still count."""
    t = DocumentTable(spark, tmp_dir, "docs", ["p", "r"])
    for n in range(4):
        t.write_changes(_event_changes(spark, [("d", f"one{n}", n, 1, n)]), "one", n, "p")
    t.write_changes(_event_changes(spark, [("e", "two0", 0, 1, 0)]), "two", 0, "r")
    t.compact()
    t.write_changes(_event_changes(spark, [("e", "two1", 1, 1, 1), ("f", "new", 1, 1, 2)]), "two", 1, "r")
    # the same batch id by another run of the same pipeline
    t.write_changes(_event_changes(spark, [("g", "backfill", 0, 1, 0)]), "one-backfill", 0, "p")
    want = [("d", "one3"), ("e", "two1"), ("f", "new"), ("g", "backfill")]
    assert sorted((r.id, r.a) for r in t.documents().collect()) == want
    t.compact()
    assert sorted((r.id, r.a) for r in t.documents().collect()) == want
    assert t.pending() is None


def test_compaction_rewrites_touched_parts_only(spark, tmp_dir):
    t = DocumentTable(spark, tmp_dir, "docs", ["s"])
    parts = F.when(F.col("id") == "d", "2024-01").otherwise("2024-02")
    rows = _event_changes(spark, [("d", "x", 10, 1, 0), ("e", "y", 11, 1, 1)]).withColumn("date_part", parts)
    t.write_changes(rows, "j", 0, "s")
    t.compact()
    late = _event_changes(spark, [("e", "z", 12, 1, 2)]).withColumn("date_part", parts)
    t.write_changes(late, "j", 1, "s")
    month = t.documents().where("date_part = '2024-01'")
    assert [(r.id, r.a) for r in month.collect()] == [("d", "x")]
    before = set(list_paths(spark, f"{tmp_dir}/docs/documents/date_part=2024-01/part-*"))
    t.compact()
    assert before == set(list_paths(spark, f"{tmp_dir}/docs/documents/date_part=2024-01/part-*"))
    assert sorted((r.date_part, r.batch_id) for r in t.ledger().collect()) == [("2024-01", 0), ("2024-02", 0), ("2024-02", 1)]
    assert sorted((r.id, r.a) for r in t.documents().collect()) == [("d", "x"), ("e", "z")]
    files = set(list_paths(spark, f"{tmp_dir}/docs/documents/*/part-*"))
    t.compact()  # nothing new
    assert files == set(list_paths(spark, f"{tmp_dir}/docs/documents/*/part-*"))


def test_rows_without_date_part_are_rejects(spark, tmp_dir):
    t = DocumentTable(spark, tmp_dir, "docs", ["s"])
    rows = _event_changes(spark, [("d", "x", 10, 1, 0), ("e", "y", 11, 1, 1), (None, "z", 12, 1, 2)])
    rows = rows.withColumn("date_part", F.when(F.col("a") != "y", F.lit("2024-01")))
    t.write_changes(rows, "j", 0, "s")
    for _ in range(2):
        assert [(r.id, r.a) for r in t.documents().collect()] == [("d", "x")]
        assert sorted(r.a for r in t.rejects().collect()) == ["y", "z"]
        t.compact()


def test_hot_key_merge_and_latest(spark):
    """One key holds a third of all rows: results stay whole and exact."""
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string")))
        .alias("id"),
        F.lit("w").alias("date_part"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("a"),
        F.struct(F.col("id").alias("t"), F.lit(1).alias("rank"), F.lit(0).alias("partition"),
                 F.col("id").alias("offset")).alias("seq"))
    merged = {r.id: r.a for r in merge_documents(df).collect()}
    assert len(merged) == 1 + 997
    hot_max = max(i for i in range(n) if i % 3 == 0 and i % 7 != 0)
    assert merged["hot"] == str(hot_max)
    # a hot key is folded in pieces first; the others in one exchange, one sort, one pass
    hot = hot_keys(df, rows=5000)
    assert [r.id for r in hot.collect()] == ["hot"] and hot_keys(df) is None
    pieces = merge_documents(df, hot=hot)
    assert {r.id: r.a for r in pieces.collect()} == merged
    assert "__salt" in pieces._jdf.queryExecution().executedPlan().toString()
    plan = merge_documents(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("Sort [") == plan.count("Window [") == 1

    rows = df.select(F.col("id").alias("player_id"), F.lit("c").alias("cluster_id"),
                     F.col("seq.t").alias("event_ts"))
    latest = {r.player_id: r.event_ts for r in latest_per_key(rows, ["player_id", "cluster_id"]).collect()}
    assert latest["hot"] == max(i for i in range(n) if i % 3 == 0)
    plan = latest_per_key(rows, ["player_id", "cluster_id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_batches_in_any_order_are_folded(spark, tmp_dir):
    """A batch that comes after later ones were compacted still counts."""
    t = DocumentTable(spark, tmp_dir, "docs", ["s"])
    for n in (10, 11, 1):
        t.write_changes(_event_changes(spark, [(f"d{n}", "x", n, 1, n)]), "j", n, "s")
        t.compact()
    assert sorted(r.id for r in t.documents().collect()) == ["d1", "d10", "d11"]
    assert t.pending() is None


def test_a_corrected_batch_is_folded_again(spark, tmp_dir):
    t = DocumentTable(spark, tmp_dir, "docs", ["s"])
    t.write_changes(_event_changes(spark, [("d", "wrong", 5, 1, 0), ("e", "y", 6, 1, 1)]), "j", 0, "s")
    t.compact()
    t.write_changes(_event_changes(spark, [("d", "right", 5, 1, 0), ("e", "y", 6, 1, 1)]), "j", 0, "s")
    for _ in range(2):
        assert sorted((r.id, r.a) for r in t.documents().collect()) == [("d", "right"), ("e", "y")]
        t.compact()


def test_a_part_that_was_put_back_gets_its_changes_again(spark, tmp_dir):
    """What another compaction may do to a date part: the old part returns after the new one was written."""
    import shutil
    t = DocumentTable(spark, tmp_dir + "/t", "docs", ["s"])
    part = F.when(F.col("id") == "d", "2024-01").otherwise("2024-02")
    t.write_changes(_event_changes(spark, [("d", "x", 1, 1, 0), ("e", "y", 2, 1, 1)]).withColumn("date_part", part), "j", 0, "s")
    t.compact()
    shutil.copytree(f"{tmp_dir}/t/docs/documents/date_part=2024-02", f"{tmp_dir}/old")
    t.write_changes(_event_changes(spark, [("d", "x2", 3, 1, 2), ("e", "y2", 4, 1, 3)]).withColumn("date_part", part), "j", 1, "s")
    t.compact()
    shutil.rmtree(f"{tmp_dir}/t/docs/documents/date_part=2024-02")
    shutil.copytree(f"{tmp_dir}/old", f"{tmp_dir}/t/docs/documents/date_part=2024-02")
    for _ in range(2):
        assert sorted((r.id, r.a) for r in t.documents().collect()) == [("d", "x2"), ("e", "y2")]
        assert {r.date_part for r in t.pending().collect()} == {"2024-02"} if _ == 0 else t.pending() is None
        t.compact()


def test_fields_of_newer_batches(spark, tmp_dir):
    """A column that only a later batch has is a field of the documents, before and after a compaction."""
    for buckets in (None, 2):
        t = DocumentTable(spark, f"{tmp_dir}/{buckets}", "docs", ["s"], buckets=buckets)
        t.write_changes(_event_changes(spark, [("d", "x", 1, 1, 0)]), "j", 0, "s")
        t.compact()
        more = _event_changes(spark, [("d", None, 2, 1, 1), ("e", "y", 3, 1, 2)]).withColumn("b", F.col("id"))
        t.write_changes(more, "j", 1, "s")
        for _ in range(2):
            assert sorted((r.id, r.a, r.b) for r in t.documents().collect()) == [("d", "x", "d"), ("e", "y", "e")]
            t.compact()
        t.write_changes(_event_changes(spark, [("f", "z", 4, 1, 3)]), "j", 2, "s")
        t.compact()
        assert sorted((r.id, r.a, r.b) for r in t.documents().collect()) == [("d", "x", "d"), ("e", "y", "e"), ("f", "z", None)]


def test_bucketed_documents_are_not_shuffled(spark, tmp_dir):
    t = DocumentTable(spark, tmp_dir, "docs", ["s"], buckets=3)
    t.write_changes(_event_changes(spark, [(f"d{i}", "x", i, 1, i) for i in range(50)]), "j", 0, "s")
    t.compact()
    t.write_changes(_event_changes(spark, [(f"d{i}", "y", 100 + i, 1, 100 + i) for i in range(0, 70, 7)]), "j", 1, "s")
    docs = t.documents()
    assert {r.id: r.a for r in docs.collect()} == {**{f"d{i}": "x" for i in range(50)}, **{f"d{i}": "y" for i in range(0, 70, 7)}}
    merged = t._merged(t._compacted(), t.pending(), keep_orders=True)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    # one exchange, on the side of the changes; the documents are read bucket by bucket
    assert plan.count("Exchange hashpartitioning(__id") == 1 and "Bucketed: true" in plan
    assert "Exchange hashpartitioning(date_part" not in plan and plan.count("Sort [date_part") == 1
    # another session declares the folder anew
    again = DocumentTable(spark, tmp_dir, "docs", ["s"], buckets=3)
    again.compact()
    assert again.documents().count() == 52 and again.pending() is None


def test_declared_schema_reads_what_batches_lack(spark, tmp_dir):
    from pyspark.sql import types as T
    declared = T.StructType().add("id", "string").add("a", "string").add("b", "string").add("date_part", "string")
    t = DocumentTable(spark, tmp_dir, "docs", ["s"], schema=lambda sources: declared)
    t.write_changes(_event_changes(spark, [("d", "x", 1, 1, 0)]), "j", 0, "s")
    assert [(r.id, r.a, r.b) for r in t.documents().collect()] == [("d", "x", None)]
