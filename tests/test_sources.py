"""S2-S7, S9, F1, F4 on hand-made lines."""

import json

import pytest

from playerledger import schema
from playerledger.sources import (archive_range_scan, currency_rates, daily_currency_rates, dead_letters,
                                  dimension_from_lines, dimension_rejects, latest_rates, offset_audit, rates_with_refresh,
                                  parse_events, prefilter_event_names, prefilter_product_action, rates_of_days, source_ranges,
                                  store_daily_rates, total_messages)


def _lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_prefilter_and_dead_letters(spark):
    lines = _lines(spark, ['{"event_name":"LOGIN"}', '{"event_name":"BATTLE"}', "not json", '{"x":1}',
                           '{"event_name":5}', '{"event_name":"LOGIN","extra":{"a":1}}'])
    kept = prefilter_event_names(lines, ["LOGIN"]).collect()
    assert len(kept) == 2
    dead = [r.value for r in dead_letters(lines).collect()]
    assert "not json" in dead and '{"x":1}' in dead


def test_prefilter_product_action(spark):
    lines = _lines(spark, ['{"product_action_id":3}', '{"product_action_id":"3"}', '{"product_action_id":4}', "{"])
    assert prefilter_product_action(lines, 3).count() == 2


def test_parse_permissive_wrong_type(spark):
    fields = schema.union_fields(schema.SET_LEVEL)
    lines = _lines(spark, ['{"event_name":"SET_LEVEL","level_id":1.5,"level_type_id":1,"unknown":"z"}',
                           '{"event_name":"SET_LEVEL","level_id":4,"level_type_id":2}'])
    rows = parse_events(lines, fields).orderBy("level_type_id").collect()
    assert rows[0].level_id is None and rows[0].level_type_id == 1 and rows[0]._corrupt_record is not None
    assert rows[1].level_id == 4 and rows[1]._corrupt_record is None


def test_dimension_lines(spark):
    lines = _lines(spark, ["1|one", "1|another", "2|two|extra", "7|", "", "3", "|x", "4|four"])
    dim = {r.ref_cluster_id: r.cluster_name for r in dimension_from_lines(lines, "cluster", 0, 1).collect()}
    assert dim == {"1": "another", "2": "two", "4": "four"}
    assert dimension_rejects(lines, 0, 1).count() == 4


def test_dimension_positions(spark):
    lines = _lines(spark, ["a|10|b|c|d|Phone", "a|11|b"])
    dim = dimension_from_lines(lines, "device", 1, 5).collect()
    assert [(r.ref_device_id, r.device_name) for r in dim] == [("10", "Phone")]


def test_currency_rates_and_latest(spark):
    snaps = spark.createDataFrame(
        [(1000, json.dumps({"rates": {"EUR": 0.9, "JPY": 0.0}})), (5000, json.dumps({"rates": {"EUR": 0.8}}))],
        "as_of long, json string")
    rates = currency_rates(snaps)
    assert rates.count() == 3
    at = latest_rates(snaps, at_ms=4000).collect()
    assert [(r.curr, r.us_val) for r in at] in ([("EUR", 0.9), ("JPY", 0.0)], [("JPY", 0.0), ("EUR", 0.9)])
    stale = latest_rates(snaps, at_ms=5000 + 43_200_001).first()
    assert stale.curr == "EUR" and stale.stale is True
    assert latest_rates(snaps, at_ms=10).count() == 0


def test_rates_with_refresh_depend_on_the_batch_time_only(spark):
    row = lambda t, v: (t, json.dumps({"rates": {"EUR": v}}))
    taken = [row(1000, 0.9), row(5000, 0.8)]
    at = rates_with_refresh(lambda: spark.createDataFrame(taken, "as_of long, json string"), ttl_ms=100)
    first = at(5050).collect()
    assert [(r.us_val, r.stale) for r in first] == [(0.8, False)]
    taken.append(row(9000, 0.7))  # a replay later, with newer snapshots there
    assert at(5050).collect() == first
    assert [(r.us_val, r.stale) for r in at(9500).collect()] == [(0.7, True)]
    assert at(10).count() == 0 and at(None).first().us_val == 0.7


def test_daily_rates_drop_malformed(spark):
    lines = _lines(spark, ["20240101|EUR|x|0.9", "bad|EUR|x|0.9", "20240101||x|0.9", "20240101|EUR", "0||0"])
    got = daily_currency_rates(lines).collect()
    assert [(r.curr_day, r.curr, r.us_val) for r in got] == [(20240101, "EUR", 0.9)]


def test_archive_partitioned_range(spark, tmp_dir):
    df = spark.createDataFrame([(f'{{"n":{i}}}', i % 5) for i in range(20)], "value string, archive_no int")
    df.write.partitionBy("archive_no").text(tmp_dir + "/arch")
    got = archive_range_scan(spark, tmp_dir + "/arch", 2, 9)
    assert got.count() == 12
    assert set(r.archive_no for r in got.select("archive_no").distinct().collect()) == {2, 3, 4}
    assert archive_range_scan(spark, tmp_dir + "/arch", 5, 4).count() == 0


def test_archive_numbered_range_skips_missing(spark, tmp_dir):
    for n in (3, 5):
        spark.createDataFrame([(f'{{"n":{n}}}',)], "value string").write.text(f"{tmp_dir}/arch{n}")
    got = archive_range_scan(spark, f"{tmp_dir}/arch", 1, 6, layout="numbered").collect()
    assert sorted(r.archive_no for r in got) == [3, 5]
    assert archive_range_scan(spark, f"{tmp_dir}/arch", 6, 9, layout="numbered").count() == 0


def test_archive_that_is_not_there_is_an_error(spark, tmp_dir):
    spark.range(3).selectExpr("cast(id as string) as value").write.text(f"{tmp_dir}/plain")
    for root, layout in ((f"{tmp_dir}/nothing", "numbered"), (f"{tmp_dir}/nothing", "partitioned"), (f"{tmp_dir}/plain", "partitioned")):
        with pytest.raises(FileNotFoundError):
            archive_range_scan(spark, root, 1, 3, layout=layout)


def test_offset_audit(spark):
    df = spark.createDataFrame([("t", 0, 5), ("t", 0, 6), ("t", 1, 9)], "topic string, partition int, offset long")
    got = {(r.topic, r.partition): (r.from_offset, r.until_offset, r.messages) for r in offset_audit(df).collect()}
    assert got == {("t", 0): (5, 7, 2), ("t", 1): (9, 10, 1)}


def test_ranges_as_the_source_declares_them():
    """A broker's offsets count with their gaps; files have none."""
    kafka = {"description": "KafkaV2", "startOffset": '{"ev":{"0":10,"1":5}}', "endOffset": '{"ev":{"0":25,"1":5,"2":7}}', "numInputRows": 12}
    files = {"description": "FileStreamSource[x]", "startOffset": '{"logOffset":0}', "endOffset": '{"logOffset":1}', "numInputRows": 9}
    rows = source_ranges([{"batchId": 3, "sources": [kafka, files, {**files, "startOffset": None, "endOffset": "none"}]}])
    assert rows == [(3, "ev", 0, 10, 25, 15), (3, "ev", 1, 5, 5, 0), (3, "ev", 2, None, 7, None),
                    (3, "FileStreamSource[x]", None, None, None, 9), (3, "FileStreamSource[x]", None, None, None, 9)]
    named = [dict(zip(("batch_id", "topic", "partition", "from_offset", "until_offset", "messages"), r)) for r in rows]
    assert total_messages([named[0], named[1], named[3]]) == 24


def test_daily_rates_by_day_and_currency(spark, tmp_dir):
    lines = _lines(spark, ["20240131|EUR|x|0.5", "20240201|EUR|x|0.25", "20240201|EUR|x|0.2", "20240201|JPY|x|bad", "20250301|EUR|x|1"])
    store_daily_rates(daily_currency_rates(lines), tmp_dir + "/r")
    facts = spark.createDataFrame([(20240131,), (20240201,), (None,)], "curr_day int")
    rates = rates_of_days(spark, tmp_dir + "/r", facts.where("curr_day > 0"))
    assert sorted(map(tuple, rates.collect())) == [(20240131, "EUR", 0.5), (20240201, "EUR", 0.25)]
    facts.write.parquet(tmp_dir + "/f")
    stored = spark.read.parquet(tmp_dir + "/f").where("curr_day > 0")
    plan = rates_of_days(spark, tmp_dir + "/r", stored)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    # months written again replace theirs only
    store_daily_rates(daily_currency_rates(_lines(spark, ["20240131|EUR|x|0.75"])), tmp_dir + "/r")
    again = rates_of_days(spark, tmp_dir + "/r", facts.where("curr_day > 0")).collect()
    assert sorted(map(tuple, again)) == [(20240131, "EUR", 0.75), (20240201, "EUR", 0.25)]
