"""P1-P5, P9-P12 on hand-made rows."""

from pyspark.sql import functions as F

from playerledger.functions import (day_key, doc_id, epoch_ms_to_datetime, event_time, key_for, month_part,
                                    sparse_string_map, usd_amount, week_part)
from playerledger.functions.columns import fill_status


def test_datetime_keeps_whole_seconds(spark):
    df = spark.createDataFrame([(1462716636780,), (0,), (-1500,), (None,)], "ms long")
    got = [r[0] for r in df.select(epoch_ms_to_datetime("ms")).collect()]
    assert got == ["2016-05-08 14:10:36.000", "1970-01-01 00:00:00.000", "1969-12-31 23:59:59.000", None]


def test_week_part_calendar_year_iso_week(spark):
    df = spark.createDataFrame([("2016-01-01",), ("2016-01-07",), ("2024-12-30",)], "d string")
    got = [r[0] for r in df.select(week_part(F.to_timestamp("d"))).collect()]
    assert got == ["2016_53", "2016_1", "2024_1"]


def test_month_and_day(spark):
    df = spark.createDataFrame([(1462716636780,)], "ms long")
    r = df.select(month_part(event_time("ms")), day_key(event_time("ms"))).first()
    assert tuple(r) == ("2016-05", "20160508")


def test_doc_id_null_part_gives_null(spark):
    df = spark.createDataFrame([("p", "c", "s"), (None, "c", "s"), ("p", None, "s"), ("p", "c", None)],
                               "player_id string, cluster_id string, session_id string")
    got = [r[0] for r in df.select(doc_id("player_id", "cluster_id", "session_id")).collect()]
    assert got == ["p_c_s", None, None, None]


def test_key_shapes(spark):
    df = spark.createDataFrame([("p", "c", 5, 7)], "player_id string, cluster_id string, event_ts long, event_order int")
    assert df.select(key_for("player_cluster_ts_order")).first()[0] == "p_c_5_7"


def test_usd_zero_and_missing_rate(spark):
    df = spark.createDataFrame([(10.0, 2.0), (10.0, 0.0), (10.0, None)], "a double, r double")
    assert [r[0] for r in df.select(usd_amount("a", "r")).collect()] == [5.0, None, None]


def test_fill_status(spark):
    df = spark.createDataFrame([(None,), (2,)], "transaction_status_id int")
    assert [r[0] for r in fill_status(df).collect()] == [-1, 2]


def test_sparse_map(spark):
    df = spark.createDataFrame([("i", None, None), ("i", "x", 3)], "id string, a string, b int")
    m = sparse_string_map([("id", F.col("id"))], ["a", "b"])
    got = [r[0] for r in df.select(m).collect()]
    assert got[0] == {"id": "i"}
    assert got[1] == {"id": "i", "a": "x", "b": "3"}
