"""DuckDB oracle SQL for the registered queries.

The oracle states each query in plain SQL over the driver tables (views
``events orders lineitem region nation supplier part``): the adapter's event
rows as typed SELECTs, the pipelines as UNION ALL BY NAME of one SELECT per
document kind, latest-per-key as a window rank, the keyed merge as
``arg_max(...) FILTER (WHERE ... IS NOT NULL)`` per field.  Only the column
lists come from the shared field constants.
"""

from __future__ import annotations

from . import catalog, schema
from .driver_tables import EVENT_FANOUT, PRIORITY_CURRENCY

SQL_TYPE = {"string": "VARCHAR", "long": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}
ALL = list(catalog.PIPELINE_EVENTS)


def T(ms: str) -> str:
    """Timestamp of the truncated second of an epoch-ms expression."""
    return f"make_timestamp((({ms}) // 1000) * 1000000)"


def DT(ms: str) -> str:
    return f"(strftime({T(ms)}, '%Y-%m-%d %H:%M:%S') || '.000')"


def WEEK(ms: str = "event_ts") -> str:
    return f"(CAST(year({T(ms)}) AS VARCHAR) || '_' || CAST(weekofyear({T(ms)}) AS VARCHAR))"


def MONTH(ms: str = "event_ts") -> str:
    return f"strftime({T(ms)}, '%Y-%m')"


def DAY(ms: str) -> str:
    return f"strftime({T(ms)}, '%Y%m%d')"


def ID(*parts: str) -> str:
    return " || '_' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)


def KEY(shape: str) -> str:
    from .functions.keys import KEY_SHAPES
    return ID(*KEY_SHAPES[shape])


def S(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


# --------------------------------------------------------------------------
# Adapter rows: one typed SELECT per (source, event name)
# --------------------------------------------------------------------------

EVENT_FIELDS = {
    "CONNECT": schema.CONNECT,
    "LOGIN": schema.LOGIN,
    "DISCONNECT": schema.union_fields(schema.BASE, schema.RESOURCES),
    "USER_PROFILE": schema.USER_PROFILE,
    "USER_GAME_PROFILE": schema.GAME_PROFILE,
    "SET_LEVEL": schema.SET_LEVEL,
    "REGISTRATION": schema.REGISTRATION,
    "DEPOSIT_TRIGGER": schema.TRIGGER,
    "PROGRESS_START": schema.PROGRESS_OPEN,
    "PROGRESS_FINISH": schema.PROGRESS_FINISH,
    "SEND_TRANSACTION": schema.union_fields(schema.DEPOSIT, schema.SEND_DEPOSIT_EXTRA),
    "TRANSACTION_RESULT": schema.DEPOSIT,
    "PRODUCT_MOVEMENTS": schema.PRODUCT_MOVEMENTS,
    "BATTLE": schema.BATTLE,
}

EV_CTE = """ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(ts) // 1000 AS ms
  FROM events)"""

ORD_CTE = """ord AS (
  SELECT *, epoch_us(o_orderdate) // 1000 + (o_orderkey % 86400) * 1000 AS send_ms
  FROM orders)"""

LI_CTE = """li AS (
  SELECT *, epoch_us(l_shipdate) // 1000 AS ms, CAST(l_quantity AS INTEGER) AS q
  FROM lineitem)"""


def _events_values(name: str) -> dict[str, str]:
    v = {"cluster_id": S("user_id % 5"), "player_id": S("user_id"), "event_ts": "ms",
         "session_id": "strftime(ts, '%Y%m%d')", "network_id": "k"}
    if name == "CONNECT":
        v["login_country_id"] = S("k % 30")
    elif name == "LOGIN":
        v.update(device_desc=S("k * 20"), device_id="'dev' || " + S("user_id % 7"),
                 os_version="'os' || " + S("k % 4"),
                 linked_player_id=f"CASE WHEN k % 2 = 1 THEN {S('user_id + 1')} END", timezone="'UTC'",
                 game_version="'1.' || " + S("k % 10"))
    elif name == "DISCONNECT":
        for n in range(1, 11):
            v[f"resource{n}_id"] = S(f"(k + {n}) % 10")
        for n in range(1, 9):
            v[f"resource_amount_{n}"] = f"(k * {n} + user_id) % 100"
        v["resource_amount_9"] = "value"
        v["resource_amount_10"] = "value * 2"
    elif name == "USER_PROFILE":
        v.update(social_id="'s' || " + S("user_id"), attribute1="'a' || " + S("k % 3"),
                 attribute2=f"CASE WHEN k % 4 = 0 THEN 'b' || {S('k')} END",
                 birthday="ms - 631152000000", email="'u' || " + S("user_id") + " || '@example.org'",
                 first_name="'F' || " + S("user_id"), last_name="'L' || " + S("k % 10"),
                 gender="CASE WHEN k % 2 = 0 THEN 'f' ELSE 'm' END", ingame_friends="k % 17",
                 language="'en'", num_friends="k")
    elif name == "USER_GAME_PROFILE":
        v.update(base_name="'base' || " + S("k"), game_language_id=S("k % 3"), game_world_id="k % 11",
                 is_test_player="0", is_vip="k % 2", location_x="CASE WHEN k % 2 = 1 THEN k END",
                 location_y="CASE WHEN k % 2 = 1 THEN k * 2 END", user_name="'user' || " + S("user_id"))
    elif name == "SET_LEVEL":
        v.update(level_type_id="k % 3", new_level_ind="1", level_id="k")
    elif name == "REGISTRATION":
        v.update(registration_date="ms - CAST(k AS BIGINT) * 86400000", login_source_id=S("k % 4"),
                 login_source_type_id=S("k % 2"))
    elif name == "DEPOSIT_TRIGGER":
        v.update(internal_transaction_id=S("event_id"), item_id=S("k * 20"), item_name="'item' || " + S("k"),
                 action_id="k % 25", trigger_group_type="'g' || " + S("k % 3"),
                 trigger_group_type_id=S("k % 3"), trigger_id=S("k"), trigger_type="'offer'")
    elif name in ("PROGRESS_START", "PROGRESS_FINISH"):
        ptype = S("k % 3 + 1")
        v.update(keyid=S("k * 20"), progress_type=ptype)
        if name == "PROGRESS_START":
            v.update(category_type="'cat' || " + S("k % 4"), category_id=S("k % 4"),
                     sub_category_id=S("k % 7"), sub_category_type="'sub'", keyname="'quest' || " + S("k"),
                     start_rate=f"CASE WHEN {ptype} = '2' THEN {S('k')} || '%' END")
        else:
            v.update(state="k % 5", finish_rate=S("k") + " || '%'")
    return v


def _currency_case(col: str, skip=()) -> str:
    whens = " ".join(f"WHEN '{p}' THEN '{c}'" for p, c in PRIORITY_CURRENCY.items() if c not in skip)
    return f"CASE {col} {whens} END"


def _orders_values(name: str) -> dict[str, str]:
    v = {"cluster_id": S("o_custkey % 5"), "player_id": S("o_custkey"),
         "session_id": "strftime(o_orderdate, '%Y%m%d')", "network_id": "o_custkey % 100",
         "internal_transaction_id": S("o_orderkey"), "offer_id": "o_orderpriority",
         "deposit_amount": "o_totalprice", "deposit_currency": _currency_case("o_orderpriority"),
         "transaction_source_id": "o_custkey % 5", "external_transaction_id": "'ext' || " + S("o_orderkey"),
         "bonus_amount_1": "o_custkey % 100", "bonus_amount_2": "o_orderkey % 7",
         "receive_amount_1": "o_custkey % 13"}
    if name == "SEND_TRANSACTION":
        v.update(event_ts="send_ms", original_offer_amount="o_totalprice", payment_method_id="o_orderkey % 5")
    else:
        v["event_ts"] = "send_ms + (o_orderkey % 48 + 1) * 3600000"
        v["transaction_status_id"] = (
            "CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN NULL "
            "WHEN o_orderstatus = 'O' THEN 1 "
            "WHEN o_orderstatus = 'F' AND o_orderpriority = '4-NOT SPECIFIED' THEN 3 "
            "WHEN o_orderstatus = 'F' THEN 2 "
            "WHEN o_orderpriority = '1-URGENT' THEN 5 "
            "WHEN o_orderpriority = '2-HIGH' THEN 9 ELSE 4 END")
    return v


def _lineitem_values(name: str) -> dict[str, str]:
    v = {"cluster_id": S("l_suppkey % 5"), "player_id": S("l_suppkey"), "network_id": "l_partkey % 100",
         "event_ts": "ms"}
    if name == "PRODUCT_MOVEMENTS":
        v.update(event_order="l_linenumber", product_action_id="l_linenumber % 5", product_id=S("l_partkey"),
                 product_name="'part' || " + S("l_partkey"), product_count="q", bonus_amount="l_linenumber * 10",
                 bonus_product_id="l_partkey % 50", movement_source_id=S("l_suppkey % 25"),
                 movement_source_type_id=S("l_linenumber % 3"), package_id=S("l_orderkey"),
                 player_target_id=S("l_orderkey % 1000"), payment_product_id_1=S("l_partkey"),
                 payment_product_name_1="'flag' || l_returnflag", payment_amount_1="q",
                 payment_product_id_2=S("l_suppkey"), payment_product_name_2="'status' || l_linestatus",
                 payment_amount_2="l_linenumber")
    else:
        v.update(session_id="strftime(l_shipdate, '%Y%m%d')", attacker_ind="l_linenumber % 2",
                 battle_id=S("l_orderkey"), battle_source_id="l_returnflag", battle_type_id="l_linenumber % 5",
                 base_id=S("l_partkey"), base_level="l_linenumber", base_status_id="l_linenumber % 3",
                 base_type_id="l_linenumber % 4",
                 battle_win_ind="CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END", actual_travel_time="q",
                 main_attacker_ind="l_linenumber % 2", main_defender_ind="1 - l_linenumber % 2",
                 opponent_id=S("l_partkey % 100"), player_base_ind="1", player_defence_power="q * 10",
                 player_health_power="l_linenumber * 100", player_offence_power="q * 5", is_offline_action="0")
    return v


def _sources_of(name: str):
    """(from clause, where, partition slot, offset expr, topic, values) for an event name."""
    for etype, names in EVENT_FANOUT.items():
        if name in names:
            return ("ev", f"event_type = '{etype}'", names.index(name), "event_id", "events", _events_values(name))
    if name in ("SEND_TRANSACTION", "TRANSACTION_RESULT"):
        slot = 0 if name == "SEND_TRANSACTION" else 1
        return ("ord", "TRUE", slot, "o_orderkey", "orders", _orders_values(name))
    slot = 0 if name == "PRODUCT_MOVEMENTS" else 1
    return ("li", "TRUE", slot, "l_orderkey * 8 + l_linenumber", "lineitem", _lineitem_values(name))


def parsed_select(name: str, fields) -> str:
    """Rows of one event name as parsed with the schema ``fields`` (absent -> NULL)."""
    src, where, slot, off, topic, values = _sources_of(name)
    declared = dict(EVENT_FIELDS[name])
    cols = [f"'{topic}' AS topic", f"CAST({slot} AS INTEGER) AS partition", f"CAST({off} AS BIGINT) AS offset"]
    for f, kind in fields:
        if f == "event_name":
            expr = f"'{name}'" if f in declared else "NULL"
        elif f in declared and f in values:
            expr = values[f]
        else:
            expr = "NULL"
        cols.append(f"CAST({expr} AS {SQL_TYPE[kind]}) AS {f}")
    return f"SELECT {', '.join(cols)} FROM {src} WHERE {where}"


def parsed_cte(pipelines, name: str = "parsed", fields=None) -> str:
    from .plans import PLANS
    fields = fields or schema.union_fields(*(PLANS[p].fields for p in pipelines))
    names = catalog.events_for(pipelines)
    body = "\nUNION ALL\n".join(parsed_select(n, fields) for n in names)
    return f"{name} AS (\n{body})"


def base_ctes() -> list[str]:
    return [EV_CTE, ORD_CTE, LI_CTE]


# --------------------------------------------------------------------------
# Dimensions and rates
# --------------------------------------------------------------------------

def _dim_source(dim: str) -> str:
    """(key, name) pairs of a dimension as its text lines would yield them."""
    if dim in ("cluster", "progress_type", "progress_status", "battle_type", "product_action",
               "transaction_source", "payment_method"):
        return "SELECT CAST(r_regionkey AS VARCHAR) AS k, r_name AS n FROM region"
    if dim == "network":
        return ("SELECT CAST(n_nationkey AS VARCHAR) AS k, n_name AS n FROM nation "
                "UNION ALL SELECT CAST(s_nationkey AS VARCHAR) AS k, s_name AS n FROM supplier")
    if dim in ("country", "player_action", "movement_source_type"):
        return "SELECT CAST(n_nationkey AS VARCHAR) AS k, n_name AS n FROM nation"
    if dim == "device":
        return "SELECT CAST(p_partkey AS VARCHAR) AS k, p_name AS n FROM part"
    if dim == "quest":
        return "SELECT CAST(p_partkey AS VARCHAR) AS k, p_type AS n FROM part"
    if dim == "product":
        return "SELECT CAST(p_partkey AS VARCHAR) AS k, p_name AS n FROM part"
    raise KeyError(dim)


def dim_cte(dim: str) -> str:
    return (f"dim_{dim} AS (SELECT k AS ref_{dim}_id, min(n) AS {dim}_name FROM ({_dim_source(dim)}) s "
            f"WHERE k IS NOT NULL AND n IS NOT NULL AND k <> '' AND n <> '' GROUP BY k)")


def enriched_cte(pipelines, name: str = "enr", source: str = "parsed") -> str:
    dims = catalog.dims_for(pipelines)
    joins = "".join(
        f"\n  LEFT JOIN dim_{d} ON CAST({source}.{catalog.DIM_FACT_KEY[d]} AS VARCHAR) = dim_{d}.ref_{d}_id"
        for d in dims)
    names = ", ".join(f"dim_{d}.{d}_name" for d in dims)
    extra = (", " + names) if names else ""
    return (f"{name} AS (SELECT {source}.*{extra}, {DT('event_ts')} AS event_datetime, "
            f"event_ts AS __ts, partition AS __p, offset AS __o FROM {source}{joins})")


RATES_CTES = [
    ("snapcount AS (SELECT epoch_us(o_orderdate) // 1000 AS as_of, "
     f"{_currency_case('o_orderpriority', skip=('XTS',))} AS curr, count(*) AS n "
     "FROM orders GROUP BY ALL)"),
    ("rates_all AS (SELECT as_of, curr, CASE WHEN curr = 'USD' THEN CAST(1.0 AS DOUBLE) "
     "ELSE CAST(n % 4 AS DOUBLE) / CAST(4.0 AS DOUBLE) END AS us_val FROM snapcount WHERE curr IS NOT NULL)"),
    "rates AS (SELECT curr, us_val FROM rates_all WHERE as_of = (SELECT max(as_of) FROM rates_all))",
]


def with_ctes(ctes, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def pipeline_ctes(pipelines, parse_fields=None) -> list[str]:
    ctes = base_ctes() + [parsed_cte(pipelines, fields=parse_fields)]
    ctes += [dim_cte(d) for d in catalog.dims_for(pipelines)]
    ctes.append(enriched_cte(pipelines))
    return ctes


# --------------------------------------------------------------------------
# Pipelines: change rows (with hidden __ts, __p, __o)
# --------------------------------------------------------------------------

HIDDEN = "__ts, __p, __o"
BASE_SELECT = list(schema.BASE_SELECT)


# Output columns of the SELECTs built so far: what the merged documents must hold.
_SELECTED: list[str] = []


def _sel(rank: int, cols: list[str], src: str, where: str) -> str:
    _SELECTED.extend(c.rsplit(" AS ", 1)[-1] for c in cols)
    return f"SELECT CAST({rank} AS INTEGER) AS write_rank, {', '.join(cols)}, {HIDDEN} FROM {src} WHERE {where}"


def _names(*lists, drop=()):
    return [n for n in schema.names(*lists) if n not in drop]


def changes_sql(p: str) -> tuple[list[str], str]:
    """(ctes, body) producing the change rows of pipeline ``p``."""
    ctes = pipeline_ctes([p])
    if p == "sessions":
        ctes.append(f"b AS (SELECT *, {KEY('player_session')} AS id, {WEEK()} AS date_part FROM enr "
                    "WHERE event_name IN ('CONNECT', 'LOGIN', 'DISCONNECT'))")
        body = "\nUNION ALL BY NAME\n".join([
            _sel(1, _names(schema.CONNECT, BASE_SELECT) + ["id", "date_part", "country_name",
                                                             f"{DT('event_ts')} AS connect_datetime"],
                 "b", "event_name = 'CONNECT'"),
            _sel(2, _names(schema.LOGIN, BASE_SELECT) + ["id", "date_part", "device_name",
                                                           f"{DT('event_ts')} AS login_datetime"],
                 "b", "event_name = 'LOGIN'"),
            _sel(3, ["id", f"{DT('event_ts')} AS disconnect_datetime", "date_part", "event_name"],
                 "b", "event_name = 'DISCONNECT'"),
        ])
    elif p == "deposits":
        ctes += RATES_CTES
        ctes.append(
            f"b AS (SELECT enr.* REPLACE (COALESCE(transaction_status_id, -1) AS transaction_status_id), "
            f"{KEY('player_txn')} AS id, {MONTH()} AS date_part, "
            "deposit_amount / NULLIF(rates.us_val, 0) AS usd_deposit "
            "FROM enr LEFT JOIN rates ON enr.deposit_currency = rates.curr "
            "WHERE event_name IN ('SEND_TRANSACTION', 'TRANSACTION_RESULT'))")
        send = _names(schema.DEPOSIT, schema.SEND_DEPOSIT_EXTRA, BASE_SELECT,
                      ["payment_method_name", "transaction_source_name"]) + ["id", "date_part", "usd_deposit"]
        drops = ("original_offer_amount", "payment_method_id", "bonus_amount_1", "bonus_amount_2",
                 "receive_amount_1")
        approved = [c for c in send if c not in drops] + ["event_datetime AS Approved_status_time"]
        parts = [_sel(1, send, "b", "event_name = 'SEND_TRANSACTION'"),
                 _sel(2, approved, "b", "event_name = 'TRANSACTION_RESULT' AND transaction_status_id IN (1, -1)")]
        for sid, col, rank in ((2, "refused_status_time", 3), (3, "canceled_status_time", 4),
                               (4, "pending_status_time", 5), (5, "error_status_time", 6)):
            cols = ["player_id", "id", "date_part", f"event_datetime AS {col}", "event_datetime", "event_name",
                    "transaction_status_id", "session_id", "network_name", "internal_transaction_id",
                    "network_id", "cluster_id", "cluster_name"]
            parts.append(_sel(rank, cols, "b",
                              f"event_name = 'TRANSACTION_RESULT' AND transaction_status_id = {sid}"))
        body = "\nUNION ALL BY NAME\n".join(parts)
    elif p == "trigger":
        cols = _names(schema.TRIGGER, BASE_SELECT, ["player_action_name", "product_name"],
                      drop=("event_ts", "event_name"))
        body = _sel(1, cols + [f"{MONTH()} AS date_part", f"{KEY('player_cluster_session_txn')} AS id"],
                    "enr", "event_name = 'DEPOSIT_TRIGGER'")
    elif p == "userGameProfile":
        from .plans.game_profile import OPTIONAL as optional, REQUIRED
        entries = {k: (f"{KEY('player_cluster')}" if k == "id" else k) for k in REQUIRED}
        entries.update({k: k for k in optional})
        parts = []
        for k in sorted(entries):
            val = f"CAST({entries[k]} AS VARCHAR)"
            if k in REQUIRED:
                parts.append(f"COALESCE('\"{k}\":\"' || {val} || '\"', '\"{k}\":null')")
            else:
                parts.append(f"'\"{k}\":\"' || {val} || '\"'")
        doc = "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"
        body = _sel(1, [f"{KEY('player_cluster')} AS id", f"{doc} AS doc_json"], "enr",
                    "event_name = 'USER_GAME_PROFILE'")
    elif p == "profile":
        ctes.append("b AS (SELECT * FROM enr WHERE event_name = 'USER_PROFILE' AND player_id IS NOT NULL "
                    "AND cluster_id IS NOT NULL AND event_ts IS NOT NULL "
                    "QUALIFY rank() OVER (PARTITION BY player_id, cluster_id ORDER BY event_ts DESC) = 1)")
        body = _sel(1, _names(schema.USER_PROFILE, BASE_SELECT) + [f"{KEY('player_cluster')} AS id"], "b", "TRUE")
    elif p == "regs":
        cols = _names(schema.REGISTRATION, BASE_SELECT, drop=("event_ts", "registration_date"))
        body = _sel(1, cols + [f"{DT('registration_date')} AS reg_datetime", f"{KEY('player_cluster')} AS id"],
                    "enr", "event_name = 'REGISTRATION'")
    elif p == "set_level":
        ctes.append("b AS (SELECT * FROM enr WHERE event_name = 'SET_LEVEL' AND level_type_id IN (1, 2) "
                    "AND player_id IS NOT NULL AND cluster_id IS NOT NULL AND event_ts IS NOT NULL "
                    "QUALIFY rank() OVER (PARTITION BY player_id, cluster_id, level_type_id "
                    "ORDER BY event_ts DESC) = 1)")
        body = "\nUNION ALL BY NAME\n".join(
            _sel(lvl, [f"level_id AS {target}", f"{KEY('player_cluster')} AS id", "event_name"], "b",
                 f"level_type_id = {lvl}")
            for lvl, target in ((1, "main_level"), (2, "Secondary_level")))
    elif p == "resources":
        ctes.append("b AS (SELECT * FROM enr WHERE event_name = 'DISCONNECT' AND player_id IS NOT NULL "
                    "AND cluster_id IS NOT NULL AND event_ts IS NOT NULL "
                    "QUALIFY rank() OVER (PARTITION BY player_id, cluster_id ORDER BY event_ts DESC) = 1)")
        body = _sel(1, _names(schema.RESOURCES, BASE_SELECT, drop=("event_ts", "event_name"))
                    + [f"{KEY('player_cluster')} AS id"], "b", "TRUE")
    elif p == "prodMove":
        cols = _names(schema.PRODUCT_MOVEMENTS, BASE_SELECT, ["movement_source_type_name", "product_action_name"],
                      drop=("event_name", "event_order", "event_ts"))
        body = _sel(1, cols + [f"{WEEK()} AS date_part", f"{KEY('player_cluster_ts_order')} AS id"], "enr",
                    "event_name = 'PRODUCT_MOVEMENTS'")
    elif p == "battle":
        cols = _names(schema.BATTLE, BASE_SELECT, ["battle_type_name"], drop=("event_name", "event_ts"))
        body = _sel(1, cols + [f"{WEEK()} AS date_part", f"{KEY('player_cluster_session_battle')} AS id"], "enr",
                    "event_name = 'BATTLE'")
    elif p == "progress":
        sel = BASE_SELECT + ["progress_type_name", "progress_status_name", "quest_name"]
        ident = [f"{WEEK()} AS date_part", f"{KEY('player_cluster_quest')} AS id"]
        body = "\nUNION ALL BY NAME\n".join([
            _sel(1, _names(schema.PROGRESS_OPEN, sel, drop=("event_ts",))
                 + [f"{DT('event_ts')} AS open_datetime"] + ident, "enr",
                 "event_name = 'PROGRESS_START' AND progress_type = '2'"),
            _sel(2, _names(schema.PROGRESS_START, sel, drop=("event_ts",))
                 + [f"{DT('event_ts')} AS start_datetime"] + ident, "enr",
                 "event_name = 'PROGRESS_START' AND progress_type = '3'"),
            _sel(3, [ident[1], ident[0], f"{DT('event_ts')} AS finish_datetime", "event_name", "event_datetime",
                     "progress_type_name"], "enr", "event_name = 'PROGRESS_FINISH'"),
        ])
    else:
        raise KeyError(p)
    return ctes, body


def changes_query(p: str) -> str:
    ctes, body = changes_sql(p)
    ctes.append(f"ch AS (\n{body})")
    return with_ctes(ctes, f"SELECT * EXCLUDE ({HIDDEN}) FROM ch")


# --------------------------------------------------------------------------
# Merge
# --------------------------------------------------------------------------

def merge_body(fields: list[str], src: str = "ch") -> str:
    seq = "{'t': __ts, 'rank': write_rank, 'partition': __p, 'offset': __o}"
    aggs = [f"arg_max({f}, {seq}) FILTER (WHERE {f} IS NOT NULL) AS {f}" for f in fields]
    return (f"SELECT date_part, id, {', '.join(aggs)} FROM {src} "
            "WHERE date_part IS NOT NULL AND id IS NOT NULL GROUP BY date_part, id")


def _change_fields(p: str) -> list[str]:
    """Document fields of a pipeline's changes: the columns its SELECTs state."""
    _SELECTED.clear()
    changes_sql(p)
    return [c for c in dict.fromkeys(_SELECTED) if c not in ("id", "date_part")]


def merged_query(p: str, where: str = "TRUE") -> str:
    ctes, body = changes_sql(p)
    has_date = catalog.PIPELINE_TABLE[p][1] is not None
    if has_date:
        ctes.append(f"ch AS (\n{body})")
    else:
        ctes.append(f"ch0 AS (\n{body})")
        ctes.append(f"ch AS (SELECT *, '{catalog.NO_DATE_PART}' AS date_part FROM ch0)")
    ctes.append(f"m AS ({merge_body(_change_fields(p))})")
    return with_ctes(ctes, f"SELECT * FROM m WHERE {where}")


def _local_changes(p: str) -> tuple[list[str], str]:
    """Pipeline-local CTEs and body, renamed so several pipelines share one WITH."""
    pc, body = changes_sql(p)
    sfx = "_" + p.lower()
    out = []
    for c in pc[len(base_ctes()):]:
        for other in ("parsed", "enr", "b"):
            c = _rename(c, other, other + sfx)
        for d in catalog.dims_for([p]):
            c = _rename(c, f"dim_{d}", f"dim_{d}{sfx}")
        for r in ("snapcount", "rates_all", "rates"):
            c = _rename(c, r, r + sfx)
        out.append(c)
    for other in ("parsed", "enr", "b", "rates"):
        body = _rename(body, other, other + sfx)
    return out, body


# The string fields a game profile adds to the player's document.
GAME_PROFILE_FIELDS = ("player_id", "cluster_id", "event_name", "event_datetime", "base_name", "game_language_id",
                       "game_world_id", "is_test_player", "is_vip", "location_x", "location_y", "user_name")


def _table_changes(pipelines) -> tuple[list[str], str, list[str]]:
    """(ctes, union of the change rows, document fields) of pipelines that share a table."""
    ctes, parts, fields = [], [], {}
    for p in pipelines:
        local, body = _local_changes(p)
        ctes += local + [f"ch_{p.lower()} AS (\n{body})"]
        if p == "userGameProfile":
            spread = ", ".join(f"json_extract_string(doc_json, '$.{k}') AS {k}" for k in GAME_PROFILE_FIELDS)
            parts.append(f"SELECT id, write_rank, {spread}, {HIDDEN} FROM ch_{p.lower()}")
            fields.update(dict.fromkeys(GAME_PROFILE_FIELDS))
        else:
            parts.append(f"SELECT * FROM ch_{p.lower()}")
            fields.update(dict.fromkeys(_change_fields(p)))
    union = "\nUNION ALL BY NAME\n".join(parts)
    if catalog.PIPELINE_TABLE[pipelines[0]][1] is None:
        union = f"SELECT *, '{catalog.NO_DATE_PART}' AS date_part FROM ({union})"
    return ctes, union, list(fields)


def shared_batch_query() -> str:
    """For every document table and field: values set, least and largest as text."""
    ctes, parts = base_ctes(), []
    for table in sorted({t for t, _ in catalog.PIPELINE_TABLE.values()}):
        local, union, fields = _table_changes([p for p in ALL if catalog.PIPELINE_TABLE[p][0] == table])
        ctes += local + [f"u_{table} AS (\n{union})", f"m_{table} AS ({merge_body(fields, f'u_{table}')})"]
        for f in [*fields, "id"]:
            text = f"CAST(CAST(round({f} * 100) AS BIGINT) AS VARCHAR)" if _is_double(f) else f"CAST({f} AS VARCHAR)"
            parts.append(f"SELECT '{table}' AS doc_table, '{f}' AS field, count({f}) AS n, min({text}) AS least, "
                         f"max({text}) AS largest FROM m_{table}")
    return with_ctes(ctes, "\nUNION ALL\n".join(parts))


def _is_double(field: str) -> bool:
    return field == "usd_deposit" or schema.FIELD_KIND.get(field) == "double"


def player360_query(pipelines=("userGameProfile", "profile", "regs", "set_level")) -> str:
    local, union, fields = _table_changes(list(pipelines))
    return with_ctes(base_ctes() + local + [f"ch AS (\n{union})"], merge_body(fields))


def dead_letters_query() -> str:
    """Lines lost by the damage that the offset decides, and the documents of the rest."""
    ctes, body = changes_sql("regs")
    ctes.append(f"ch AS (\n{body})")
    kinds = {0: "unroutable", 1: "wrong type", 2: "no id"}
    lost = "\nUNION ALL\n".join(f"SELECT '{k}' AS kind, partition, offset FROM parsed WHERE offset % 7 = {n}"
                                 for n, k in kinds.items())
    return with_ctes(ctes, f"{lost}\nUNION ALL\nSELECT 'documents', NULL, count(DISTINCT id) FROM ch "
                           "WHERE __o % 7 > 2 AND id IS NOT NULL")


def backfill_resume_query() -> str:
    """Progress documents merged, and change rows appended, each once."""
    ctes, body = changes_sql("progress")
    ctes += [f"ch AS (\n{body})", f"m AS ({merge_body(_change_fields('progress'))})"]
    sets = ", ".join(f"count({k}_datetime) AS n_{k}" for k in ("open", "start", "finish"))
    return with_ctes(ctes, "\nUNION ALL\n".join(
        f"SELECT '{mode}' AS mode, date_part, id, count(*) AS n, {sets} FROM {src} GROUP BY date_part, id"
        for mode, src in (("update", "m"), ("append", "ch"))))


def document_counts_query() -> str:
    """Rows by document kind and without a document; dimension lines read and without key or name."""
    ctes = base_ctes() + [parsed_cte(["sessions", "deposits", "set_level", "progress"])]
    ctes.append("lvl AS (SELECT * FROM parsed WHERE event_name = 'SET_LEVEL' AND level_type_id IN (1, 2) AND player_id IS NOT NULL "
                "AND cluster_id IS NOT NULL AND event_ts IS NOT NULL "
                "QUALIFY rank() OVER (PARTITION BY player_id, cluster_id, level_type_id ORDER BY event_ts DESC) = 1)")
    status = "event_name = 'TRANSACTION_RESULT' AND COALESCE(transaction_status_id, -1)"
    kinds = [("sessions", "connect", "event_name = 'CONNECT'"), ("sessions", "login", "event_name = 'LOGIN'"),
             ("sessions", "disconnect", "event_name = 'DISCONNECT'"), ("sessions", "no_document", "FALSE"),
             ("deposits", "send", "event_name = 'SEND_TRANSACTION'"), ("deposits", "approved", f"{status} IN (1, -1)"),
             *[("deposits", k, f"{status} = {n}") for n, k in ((2, "refused"), (3, "canceled"), (4, "pending"), (5, "error"))],
             ("deposits", "no_document", f"{status} NOT IN (-1, 1, 2, 3, 4, 5)"),
             ("progress", "open", "event_name = 'PROGRESS_START' AND progress_type = '2'"),
             ("progress", "start", "event_name = 'PROGRESS_START' AND progress_type = '3'"),
             ("progress", "finish", "event_name = 'PROGRESS_FINISH'"),
             ("progress", "no_document", "event_name = 'PROGRESS_START' AND progress_type NOT IN ('2', '3')")]
    parts = [f"SELECT 'pipeline' AS what, '{p}' AS name, '{k}' AS kind, count(*) FILTER (WHERE {w}) AS n FROM parsed" for p, k, w in kinds]
    parts += [f"SELECT 'pipeline', 'set_level', '{k}', count(*) FILTER (WHERE {w}) FROM lvl"
              for k, w in (("main_level", "level_type_id = 1"), ("Secondary_level", "level_type_id = 2"), ("no_document", "FALSE"))]
    lines = {"network": ("concat_ws('|', n_nationkey, n_name, n_regionkey) AS v FROM nation UNION ALL "
                         "SELECT concat_ws('|', s_nationkey, s_name) FROM supplier"),
             "device": "concat_ws('|', p_brand, p_partkey, p_type, p_size, p_retailprice, p_name) AS v FROM part",
             "quest": "concat_ws('|', p_size, p_partkey, p_brand, p_type) AS v FROM part"}
    for d, src in lines.items():
        parts.append(f"SELECT 'dimension', '{d}', 'lines', count(*) FROM (SELECT {src})")
        parts.append(f"SELECT 'dimension', '{d}', 'discarded', count(*) FILTER (WHERE length(v) % 5 IN (0, 1)) FROM (SELECT {src})")
    return with_ctes(ctes, "\nUNION ALL\n".join(parts))


def _rename(sql: str, old: str, new: str) -> str:
    import re
    return re.sub(rf"(?<![A-Za-z0-9_.']){re.escape(old)}(?![A-Za-z0-9_'])", new, sql)


# --------------------------------------------------------------------------
# Source, function and operator queries
# --------------------------------------------------------------------------

def lines_query(pipelines, where: str = "TRUE", cols: str = "topic, partition, offset, event_name",
                extra_fields=()) -> str:
    from .plans import PLANS
    fields = schema.union_fields(*(PLANS[p].fields for p in pipelines))
    ctes = base_ctes() + [parsed_cte(pipelines, fields=fields)]
    return with_ctes(ctes, f"SELECT {cols} FROM parsed WHERE {where}")


def enriched_query(pipelines, cols: str, where: str = "TRUE", extra_ctes=()) -> str:
    ctes = pipeline_ctes(pipelines) + list(extra_ctes)
    return with_ctes(ctes, f"SELECT {cols} FROM enr WHERE {where}")


S6_AT_MS = 902062800000
S6_TIMES = (600000000000, 902016000000, 902016000000 + 43200000, S6_AT_MS, 1000000000000)


def _quote_envelope(sql: str) -> str:
    """Quote the envelope columns ``offset`` / ``partition`` (SQL keywords)."""
    import re
    sql = re.sub(r"(?<!['\"\w.])offset(?!['\"\w])", '"offset"', sql)
    return re.sub(r"(?<!['\"\w.])partition(?!['\"\w])", '"partition"', sql)


def oracle_queries() -> dict[str, str]:
    return {k: _quote_envelope(v) for k, v in _oracle_queries().items()}


def _oracle_queries() -> dict[str, str]:
    from .functions.keys import KEY_SHAPES
    q: dict[str, str] = {}
    sess_dep = catalog.events_for(["sessions", "deposits"])
    q["f1_prefilter"] = lines_query(ALL, "event_name IN (" + ", ".join(f"'{n}'" for n in sess_dep) + ")")
    q["f4_product_action"] = lines_query(["prodMove"], "product_action_id = 3", "topic, partition, offset")
    q["s7_parse"] = lines_query(ALL, "TRUE", "topic, partition, offset, event_name, player_id, cluster_id, "
                                "event_ts, network_id, deposit_amount, level_id, keyid, "
                                "CAST(NULL AS VARCHAR) AS _corrupt_record")
    q["s9_offset_audit"] = with_ctes(
        base_ctes() + [parsed_cte(ALL)],
        "SELECT topic, partition, min(offset) AS from_offset, max(offset) + 1 AS until_offset, "
        "count(*) AS messages FROM parsed GROUP BY topic, partition")
    q["s3_dim_load"] = with_ctes(
        [dim_cte(d) for d in catalog.DIM_POSITIONS],
        "\nUNION ALL\n".join(f"SELECT '{d}' AS dim, ref_{d}_id AS ref_id, {d}_name AS name FROM dim_{d}"
                              for d in catalog.DIM_POSITIONS))
    q["s4_rates_explode"] = with_ctes(RATES_CTES[:2], "SELECT as_of, curr, us_val FROM rates_all")
    q["s5_daily_rates"] = with_ctes(
        RATES_CTES[:2], f"SELECT CAST({DAY('as_of')} AS INTEGER) AS curr_day, curr, us_val FROM rates_all")
    q["s6_latest_rates"] = with_ctes(
        RATES_CTES[:2],
        f"SELECT curr, us_val, as_of, ({S6_AT_MS} - as_of) > {catalog.RATE_TTL_MS} AS stale FROM rates_all "
        f"WHERE as_of = (SELECT max(as_of) FROM rates_all WHERE as_of <= {S6_AT_MS})")
    q["s5_daily_usd"] = with_ctes(
        pipeline_ctes(["deposits"]) + RATES_CTES[:2],
        f"SELECT partition, offset, deposit_currency, CAST({DAY('event_ts')} AS INTEGER) AS curr_day, r.us_val AS us_val, "
        f"deposit_amount / NULLIF(r.us_val, 0) AS usd_deposit FROM enr LEFT JOIN rates_all r "
        f"ON enr.deposit_currency = r.curr AND {DAY('event_ts')} = {DAY('as_of')}")
    q["s9_stream_progress"] = with_ctes(
        base_ctes() + [parsed_cte(["sessions", "regs"])],
        "SELECT topic, partition, min(offset) AS from_offset, max(offset) + 1 AS until_offset, count(*) AS messages, "
        "CAST(sum(count(*)) OVER () AS BIGINT) AS declared_rows, CAST(0 AS BIGINT) AS declared_ranges "
        "FROM parsed GROUP BY topic, partition")
    q["s9_document_counts"] = document_counts_query()
    times = ", ".join(f"({t})" for t in S6_TIMES)
    q["s6_rates_refresh"] = with_ctes(
        RATES_CTES[:2] + [f"times(at_ms) AS (VALUES {times})",
                          "newest AS (SELECT at_ms, max(as_of) AS as_of FROM times JOIN rates_all ON as_of <= at_ms GROUP BY at_ms)"],
        f"SELECT CAST(at_ms AS BIGINT) AS at_ms, curr, us_val, as_of, (at_ms - as_of) > {catalog.RATE_TTL_MS} AS stale "
        "FROM newest JOIN rates_all USING (as_of)")
    sessions = ", ".join(f"'{n}'" for n in catalog.events_for(["sessions"]))
    q["s9_batch_metrics"] = with_ctes(
        base_ctes() + [parsed_cte(ALL)],
        "SELECT topic, partition, min(offset) AS from_offset, max(offset) + 1 AS until_offset, count(*) AS messages, "
        f"count(*) FILTER (WHERE event_name IN ({sessions})) AS routed, "
        "CAST(sum(count(*)) OVER () AS BIGINT) AS total, "
        f"CAST(sum(count(*) FILTER (WHERE event_name IN ({sessions}))) OVER () AS BIGINT) AS rows "
        "FROM parsed GROUP BY topic, partition")
    q["s7_dead_letters"] = dead_letters_query()
    q["s2_archive_range"] = lines_query(
        ["sessions"], f"day({T('event_ts')}) BETWEEN 10 AND 40",
        f"topic, partition, offset, CAST(day({T('event_ts')}) AS INTEGER) AS archive_no")
    q["p1_datetime"] = ("SELECT event_id, epoch_us(ts) // 1000 AS event_ts, "
                        f"{DT('epoch_us(ts) // 1000')} AS event_datetime FROM events")
    oms = "(epoch_us(o_orderdate) // 1000)"
    q["p2_week"] = f"SELECT o_orderkey, {WEEK(oms)} AS date_part FROM orders"
    q["p3_month"] = f"SELECT o_orderkey, {MONTH(oms)} AS date_part FROM orders"
    q["p4_day"] = f"SELECT o_orderkey, {DAY(oms)} AS day FROM orders"
    q["p5_doc_id"] = enriched_query(
        ALL, "topic, partition, offset, " + ", ".join(f"{ID(*parts)} AS id_{n}" for n, parts in KEY_SHAPES.items()))
    q["p9_fill"] = enriched_query(["deposits"], "offset, COALESCE(transaction_status_id, -1) AS transaction_status_id",
                                  "event_name = 'TRANSACTION_RESULT'")
    q["p10_usd"] = with_ctes(
        pipeline_ctes(["deposits"]) + RATES_CTES,
        "SELECT partition, offset, deposit_currency, deposit_amount / NULLIF(rates.us_val, 0) AS usd_deposit "
        "FROM enr LEFT JOIN rates ON enr.deposit_currency = rates.curr")
    q["j2_rates"] = with_ctes(
        pipeline_ctes(["deposits"]) + RATES_CTES,
        "SELECT partition, offset, deposit_currency, rates.us_val AS us_val "
        "FROM enr LEFT JOIN rates ON enr.deposit_currency = rates.curr")
    q["f3_predicates"] = enriched_query(
        ["set_level"], "offset, player_id, level_type_id, level_id",
        "event_name = 'SET_LEVEL' AND (level_type_id = 1 OR level_type_id = 2)")
    ctes, body = changes_sql("userGameProfile")
    q["p12_sparse_map"] = with_ctes(ctes + [f"ch AS ({body})"], "SELECT id, doc_json FROM ch")
    q["j1_dims"] = enriched_query(
        ["sessions", "progress"],
        "topic, partition, offset, event_name, cluster_name, network_name, country_name, device_name, "
        "progress_type_name, progress_status_name, quest_name")
    q["a1_max"] = enriched_query(["profile"], "player_id, cluster_id, max(event_ts) AS max_ts",
                                 "event_name = 'USER_PROFILE' GROUP BY player_id, cluster_id")
    day_ms = f"epoch_us(date_trunc('day', {T('event_ts')})) // 1000"
    daily = (f"d AS (SELECT player_id, cluster_id, {day_ms} AS day_ms, offset FROM enr "
             "WHERE event_name = 'USER_PROFILE' AND player_id IS NOT NULL AND cluster_id IS NOT NULL "
             "AND event_ts IS NOT NULL)")
    q["l1_latest_ties"] = with_ctes(
        pipeline_ctes(["profile"]) + [daily],
        "SELECT * FROM d QUALIFY rank() OVER (PARTITION BY player_id, cluster_id ORDER BY day_ms DESC) = 1")
    q["l1_latest_one"] = with_ctes(
        pipeline_ctes(["profile"]) + [daily],
        "SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY player_id, cluster_id "
        "ORDER BY day_ms DESC, offset DESC) = 1")
    names = {"sessions": "e1_sessions", "deposits": "e2_deposits", "trigger": "e3_trigger",
             "userGameProfile": "e4_user_game_profile", "profile": "e5_profile", "regs": "e6_regs",
             "set_level": "e7_set_level", "resources": "e8_resources", "prodMove": "e9_prod_move",
             "battle": "e10_battle", "progress": "e11_progress"}
    for p, key in names.items():
        q[key] = changes_query(p)
    q["k1_merge"] = merged_query("deposits")
    q["k2_append"] = f"SELECT * EXCLUDE (write_rank) FROM ({changes_query('battle')})"
    q["k3_partitioned"] = merged_query("deposits", "date_part >= '1998-01'")
    q["k4_player360"] = player360_query()
    q["t1_stream_equals_batch"] = shared_batch_query()
    q["t4_backfill"] = merged_query("progress")
    q["t5_backfill_back"] = merged_query("progress")
    q["t4_backfill_resume"] = backfill_resume_query()
    q["t3_shared_batch"] = shared_batch_query()
    q["t5_late_replay"] = merged_query("deposits")
    q["t5_two_jobs"] = player360_query(("profile", "regs", "set_level"))
    q["a2_batch_count"] = with_ctes(base_ctes() + [parsed_cte(ALL)], "SELECT count(*) AS rows FROM parsed")
    return q
