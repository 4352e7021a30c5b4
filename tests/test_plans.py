"""E1-E11 semantics on hand-made events."""

from playerledger.sources.rates import RATES_SCHEMA

from .helpers import changes

BASE = {"cluster_id": "c", "player_id": "p", "session_id": "s", "network_id": 1}


def ev(name, ts, **kw):
    return {**BASE, "event_name": name, "event_ts": ts, **kw}


def test_deposit_status_fanout(spark):
    rates = spark.createDataFrame([("EUR", 0.5), ("JPY", 0.0)], RATES_SCHEMA)
    events = [ev("SEND_TRANSACTION", 1000, internal_transaction_id="t1", deposit_amount=10.0,
                 deposit_currency="EUR", original_offer_amount=10.0, payment_method_id=2)]
    events += [ev("TRANSACTION_RESULT", 2000 + i, internal_transaction_id=f"r{i}", deposit_amount=10.0,
                  deposit_currency=cur, **({} if st is None else {"transaction_status_id": st}))
               for i, (st, cur) in enumerate([(None, "JPY"), (1, "XXX"), (2, "EUR"), (3, None), (4, "EUR"),
                                              (5, "EUR"), (9, "EUR")])]
    rows = {r.id: r for r in changes(spark, "deposits", events, rates=rates).collect()}
    assert rows["p_t1"].write_rank == 1 and rows["p_t1"].usd_deposit == 20.0
    assert rows["p_t1"].transaction_status_id == -1
    assert rows["p_r0"].Approved_status_time is not None and rows["p_r0"].usd_deposit is None
    assert rows["p_r0"].transaction_status_id == -1 and rows["p_r0"].payment_method_id is None
    assert rows["p_r1"].write_rank == 2
    assert rows["p_r2"].refused_status_time is not None and rows["p_r2"].usd_deposit is None
    assert rows["p_r3"].canceled_status_time and rows["p_r4"].pending_status_time and rows["p_r5"].error_status_time
    assert "p_r6" not in rows
    assert rows["p_t1"].date_part == "1970-01"


def test_deposits_without_rates(spark):
    events = [ev("SEND_TRANSACTION", 1000, internal_transaction_id="t1", deposit_amount=10.0, deposit_currency="EUR")]
    r = changes(spark, "deposits", events).first()
    assert r.usd_deposit is None


def test_sessions_split_across_week_end(spark):
    sunday = 1704585600000 + 23 * 3600000  # 2024-01-07 23:00 UTC (ISO week 1)
    monday = sunday + 2 * 3600000          # 2024-01-08 01:00 UTC (ISO week 2)
    events = [ev("CONNECT", sunday, login_country_id="7"), ev("LOGIN", sunday + 1, device_desc="d"),
              ev("DISCONNECT", monday)]
    rows = changes(spark, "sessions", events, {"country": ["7|Neverland"]}).collect()
    parts = sorted((r.write_rank, r.date_part) for r in rows)
    assert parts == [(1, "2024_1"), (2, "2024_1"), (3, "2024_2")]
    connect = [r for r in rows if r.write_rank == 1][0]
    assert connect.country_name == "Neverland" and connect.connect_datetime == "2024-01-07 23:00:00.000"


def test_progress_types(spark):
    q = {"keyid": "q1"}
    events = [ev("PROGRESS_START", 1000, progress_type="2", start_rate="5", **q),
              ev("PROGRESS_START", 2000, progress_type="3", **q),
              ev("PROGRESS_START", 3000, progress_type="9", **q),
              ev("PROGRESS_FINISH", 4000, state=1, progress_type="3", **q)]
    rows = sorted(changes(spark, "progress", events, {"progress_status": ["1|done"]}).collect(),
                  key=lambda r: r.write_rank)
    assert [r.write_rank for r in rows] == [1, 2, 3]
    assert rows[0].open_datetime and rows[1].start_datetime and rows[2].finish_datetime
    assert {r.id for r in rows} == {"p_c_q1"}


def test_set_level_types(spark):
    events = [ev("SET_LEVEL", 10, level_type_id=1, level_id=3), ev("SET_LEVEL", 20, level_type_id=1, level_id=4),
              ev("SET_LEVEL", 15, level_type_id=2, level_id=7), ev("SET_LEVEL", 30, level_type_id=3, level_id=9)]
    rows = {r.write_rank: r for r in changes(spark, "set_level", events).collect()}
    assert rows[1].main_level == 4 and rows[1].Secondary_level is None
    assert rows[2].Secondary_level == 7 and len(rows) == 2


def test_profile_latest_with_tie(spark):
    events = [ev("USER_PROFILE", 10, email="a"), ev("USER_PROFILE", 20, email="b"),
              ev("USER_PROFILE", 20, email="c")]
    got = sorted(r.email for r in changes(spark, "profile", events).collect())
    assert got == ["b", "c"]


def test_game_profile_sparse(spark):
    events = [{"event_name": "USER_GAME_PROFILE", "event_ts": 1, "cluster_id": "c", "player_id": "p"},
              {"event_name": "USER_GAME_PROFILE", "event_ts": 2, "cluster_id": "c", "player_id": "p",
               "is_vip": 1}]
    docs = sorted((r.doc for r in changes(spark, "userGameProfile", events).collect()), key=len)
    assert set(docs[0]) == {"id", "event_datetime", "player_id", "event_name", "cluster_id"}
    assert docs[1]["is_vip"] == "1"


def test_regs_and_prod_move_ids(spark):
    r = changes(spark, "regs", [ev("REGISTRATION", 5, registration_date=1462716636780)]).first()
    assert r.reg_datetime == "2016-05-08 14:10:36.000" and r.id == "p_c"
    m = changes(spark, "prodMove", [ev("PRODUCT_MOVEMENTS", 5, event_order=2)]).first()
    assert m.id == "p_c_5_2" and "event_order" not in m.asDict()
