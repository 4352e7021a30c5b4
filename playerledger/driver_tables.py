"""Adapter: the driver's parquet tables as a game-event feed.

The tables (``events``, ``orders``, ``lineitem`` plus the small ``region``,
``nation``, ``supplier``, ``part``) are re-expressed in the feed's vocabulary
so the real ingest path runs on them: raw JSON lines -> prefilter -> typed
parse -> dimension joins -> event plans.  Everything is derived by Spark from
the tables in one scan per table, so the work grows with them.

Mapping (fixed values of the adapter):

* events: player = user_id, cluster = user_id % 5, network_id = props.k,
  event_ts = epoch ms of ts, session = yyyyMMdd of ts.  Event types fan out:
  view -> CONNECT, USER_PROFILE, USER_GAME_PROFILE; click -> LOGIN, SET_LEVEL,
  PROGRESS_START; error -> DISCONNECT; purchase -> DEPOSIT_TRIGGER,
  PROGRESS_FINISH; signup -> REGISTRATION.
* orders: SEND_TRANSACTION and TRANSACTION_RESULT per order (player =
  o_custkey, transaction = o_orderkey, amount = o_totalprice, currency by
  priority, status by order status and priority).
* lineitem: PRODUCT_MOVEMENTS and BATTLE per line (player = l_suppkey,
  time = l_shipdate, event_order = l_linenumber, battle = l_orderkey).
* dimensions: pipe-delimited lines built from region / nation / supplier /
  part, laid out so each dimension's (key, name) positions apply.
* currency rates: one snapshot per order day, ``{"rates": {...}}``.

Envelope: topic = source table, partition = fan-out slot, offset = row id.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import catalog, schema
from .sources.dims import dimension_from_lines


_SPLITS: dict = {}

#: Bytes of a table file that one task turns into JSON lines, about: a line takes some fifty
#: times what its row takes in the file.
BYTES_A_TASK = 4 << 20
#: Bytes of the table files whose lines make one file of a stream, about: some 20 MB of parquet,
#: which a reading task holds as a whole.
BYTES_A_FILE = 1 << 20
#: Slots whose JSON one operator makes at most.
MOST_SLOTS = 6


def _bytes(df: DataFrame) -> int:
    """The size of a scan's files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _tasks(df: DataFrame) -> int:
    """Tasks of ``BYTES_A_TASK`` for the files of a scan."""
    return -(-_bytes(df) // BYTES_A_TASK)


def event_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for what is made of the ``events`` table."""
    return _tasks(spark.read.parquet(f"{sf_dir}/events.parquet"))


def feed_files(spark: SparkSession, sf_dir: str) -> int:
    """Files that the whole feed's lines make, of ``BYTES_A_FILE`` each."""
    return -(-sum(_bytes(spark.read.parquet(f"{sf_dir}/{t}.parquet")) for t in ("events", "orders", "lineitem")) // BYTES_A_FILE)


def _read(spark: SparkSession, sf_dir: str, name: str, key: str | None = None) -> DataFrame:
    """Scan a table; spread it by ``key`` when the scan has too few splits for its size.

    The driver files may be single row groups (one split each), so without this one
    task would do all JSON work.  A task gets ``BYTES_A_TASK``, and there are no fewer
    tasks than cores, so that the tasks stay alike as the table grows.  An input of
    enough splits is left alone (no shuffle).  Hash partitioning on a key is
    deterministic, so a retried task sees the same rows.
    """
    path = f"{sf_dir}/{name}.parquet"
    df = spark.read.parquet(path)
    if key is not None:
        try:
            target = spark.sparkContext.defaultParallelism
        except Exception:  # sessions without a SparkContext handle
            target = 8
        if (path, target) not in _SPLITS:
            try:
                _SPLITS[(path, target)] = df.rdd.getNumPartitions(), _tasks(df)
            except Exception:  # no RDD access (e.g. a remote session): keep the scan as is
                _SPLITS[(path, target)] = target, target
        splits, wanted = _SPLITS[(path, target)]
        if splits < target or 2 * splits < wanted:
            df = df.repartition(max(target, wanted), key)
    return df


def _ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


# Event type -> emitted event names (fan-out slot = position).
EVENT_FANOUT = {
    "view": ("CONNECT", "USER_PROFILE", "USER_GAME_PROFILE"),
    "click": ("LOGIN", "SET_LEVEL", "PROGRESS_START"),
    "error": ("DISCONNECT",),
    "purchase": ("DEPOSIT_TRIGGER", "PROGRESS_FINISH"),
    "signup": ("REGISTRATION",),
}

# Order priority -> currency ("XTS" has no rate).
PRIORITY_CURRENCY = {
    "1-URGENT": "EUR",
    "2-HIGH": "GBP",
    "3-MEDIUM": "USD",
    "4-NOT SPECIFIED": "JPY",
    "5-LOW": "XTS",
}


_EVENT_FIELDS = {
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


def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


def _json(name: str, values: dict[str, str]) -> str:
    """SQL: JSON object with the event's declared fields, in declared order; nulls omitted."""
    parts = []
    for field, kind in _EVENT_FIELDS[name]:
        if field == "event_name":
            parts.append(f"'{field}', '{name}'")
        elif field in values:
            parts.append(f"'{field}', CAST({values[field]} AS {kind.upper() if kind != "long" else "BIGINT"})")
    return f"to_json(named_struct({', '.join(parts)}))"


# Event field values as Spark SQL expressions over the source row.  They are
# kept as SQL text so a whole projection is parsed once by the JVM.

def _events_values(name: str) -> dict[str, str]:
    v = {"cluster_id": "cluster", "player_id": "player", "event_ts": "ms", "session_id": "day", "network_id": "k"}
    if name == "CONNECT":
        v["login_country_id"] = _s("k % 30")
    elif name == "LOGIN":
        v.update(device_desc=_s("k * 20"), device_id="concat('dev', " + _s("user_id % 7") + ")",
                 os_version="concat('os', " + _s("k % 4") + ")",
                 linked_player_id=f"CASE WHEN k % 2 = 1 THEN {_s('user_id + 1')} END", timezone="'UTC'",
                 game_version="concat('1.', " + _s("k % 10") + ")")
    elif name == "DISCONNECT":
        for n in range(1, 11):
            v[f"resource{n}_id"] = _s(f"(k + {n}) % 10")
        for n in range(1, 9):
            v[f"resource_amount_{n}"] = f"(k * {n} + user_id) % 100"
        v["resource_amount_9"] = "value"
        v["resource_amount_10"] = "value * 2"
    elif name == "USER_PROFILE":
        v.update(social_id="concat('s', " + _s("user_id") + ")", attribute1="concat('a', " + _s("k % 3") + ")",
                 attribute2=f"CASE WHEN k % 4 = 0 THEN concat('b', {_s('k')}) END",
                 birthday="ms - 631152000000", email="concat('u', " + _s("user_id") + ", '@example.org')",
                 first_name="concat('F', " + _s("user_id") + ")", last_name="concat('L', " + _s("k % 10") + ")",
                 gender="CASE WHEN k % 2 = 0 THEN 'f' ELSE 'm' END", ingame_friends="k % 17",
                 language="'en'", num_friends="k")
    elif name == "USER_GAME_PROFILE":
        v.update(base_name="concat('base', " + _s("k") + ")", game_language_id=_s("k % 3"),
                 game_world_id="k % 11", is_test_player="0", is_vip="k % 2",
                 location_x="CASE WHEN k % 2 = 1 THEN k END", location_y="CASE WHEN k % 2 = 1 THEN k * 2 END",
                 user_name="concat('user', " + _s("user_id") + ")")
    elif name == "SET_LEVEL":
        v.update(level_type_id="k % 3", new_level_ind="1", level_id="k")
    elif name == "REGISTRATION":
        v.update(registration_date="ms - CAST(k AS BIGINT) * 86400000", login_source_id=_s("k % 4"),
                 login_source_type_id=_s("k % 2"))
    elif name == "DEPOSIT_TRIGGER":
        v.update(internal_transaction_id=_s("event_id"), item_id=_s("k * 20"),
                 item_name="concat('item', " + _s("k") + ")", action_id="k % 25",
                 trigger_group_type="concat('g', " + _s("k % 3") + ")", trigger_group_type_id=_s("k % 3"),
                 trigger_id=_s("k"), trigger_type="'offer'")
    elif name in ("PROGRESS_START", "PROGRESS_FINISH"):
        ptype = _s("k % 3 + 1")
        v.update(keyid=_s("k * 20"), progress_type=ptype)
        if name == "PROGRESS_START":
            v.update(category_type="concat('cat', " + _s("k % 4") + ")", category_id=_s("k % 4"),
                     sub_category_id=_s("k % 7"), sub_category_type="'sub'",
                     keyname="concat('quest', " + _s("k") + ")",
                     start_rate=f"CASE WHEN {ptype} = '2' THEN concat({_s('k')}, '%') END")
        else:
            v.update(state="k % 5", finish_rate=f"concat({_s('k')}, '%')")
    return v


def _currency_sql(col: str, skip=()) -> str:
    whens = " ".join(f"WHEN '{p}' THEN '{c}'" for p, c in PRIORITY_CURRENCY.items() if c not in skip)
    return f"CASE {col} {whens} END"


def _orders_values(name: str) -> dict[str, str]:
    v = {"cluster_id": _s("o_custkey % 5"), "player_id": _s("o_custkey"),
         "session_id": "date_format(o_orderdate, 'yyyyMMdd')", "network_id": "o_custkey % 100",
         "internal_transaction_id": _s("o_orderkey"), "offer_id": "o_orderpriority",
         "deposit_amount": "o_totalprice", "deposit_currency": _currency_sql("o_orderpriority"),
         "transaction_source_id": "o_custkey % 5", "external_transaction_id": "concat('ext', " + _s("o_orderkey") + ")",
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
    v = {"cluster_id": _s("l_suppkey % 5"), "player_id": _s("l_suppkey"), "network_id": "l_partkey % 100",
         "event_ts": "ms"}
    if name == "PRODUCT_MOVEMENTS":
        v.update(event_order="l_linenumber", product_action_id="l_linenumber % 5", product_id=_s("l_partkey"),
                 product_name="concat('part', " + _s("l_partkey") + ")", product_count="q",
                 bonus_amount="l_linenumber * 10", bonus_product_id="l_partkey % 50",
                 movement_source_id=_s("l_suppkey % 25"), movement_source_type_id=_s("l_linenumber % 3"),
                 package_id=_s("l_orderkey"), player_target_id=_s("l_orderkey % 1000"),
                 payment_product_id_1=_s("l_partkey"), payment_product_name_1="concat('flag', l_returnflag)",
                 payment_amount_1="q", payment_product_id_2=_s("l_suppkey"),
                 payment_product_name_2="concat('status', l_linestatus)", payment_amount_2="l_linenumber")
    else:
        v.update(session_id="date_format(l_shipdate, 'yyyyMMdd')", attacker_ind="l_linenumber % 2",
                 battle_id=_s("l_orderkey"), battle_source_id="l_returnflag", battle_type_id="l_linenumber % 5",
                 base_id=_s("l_partkey"), base_level="l_linenumber", base_status_id="l_linenumber % 3",
                 base_type_id="l_linenumber % 4",
                 battle_win_ind="CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END", actual_travel_time="q",
                 main_attacker_ind="l_linenumber % 2", main_defender_ind="1 - l_linenumber % 2",
                 opponent_id=_s("l_partkey % 100"), player_base_ind="1", player_defence_power="q * 10",
                 player_health_power="l_linenumber * 100", player_offence_power="q * 5", is_offline_action="0")
    return v


def _fanout(df: DataFrame, topic: str, slots: list[tuple[str, str, int]], values_of) -> DataFrame:
    """One scan: each row becomes the JSON lines of the slots whose predicate holds.

    No two different predicates hold for one row.
    """
    lines: dict[str, list[str]] = {}
    for pred, name, slot in slots:
        lines.setdefault(pred, []).append(f"named_struct('value', {_json(name, values_of(name))}, 'partition', {slot})")
    # no filter over the array: it would take the whole expression out of the generated code
    arrays = {pred: f"array({', '.join(some)})" for pred, some in lines.items()}
    if len(slots) > MOST_SLOTS:
        # a first part as a column: every operator has a function of its own there, and one of
        # over 8000 bytes is not compiled
        half = list(arrays)[:len(arrays) // 2]
        df = df.selectExpr("*", f"CASE {' '.join(f'WHEN {pred} THEN {arrays[pred]}' for pred in half)} END AS __lines")
        arrays |= dict.fromkeys(half, "__lines")
    cases = " ".join(f"WHEN {pred} THEN {some}" for pred, some in arrays.items())
    return df.selectExpr(f"explode(CASE {cases} END) AS l", "__off").selectExpr(
        "l.value AS value", f"'{topic}' AS topic", "CAST(l.partition AS INT) AS partition",
        "CAST(__off AS BIGINT) AS offset")


def game_event_lines(spark: SparkSession, sf_dir: str, pipelines: Iterable[str] | None = None) -> DataFrame:
    """Raw event envelope (value, topic, partition, offset) for the given pipelines."""
    wanted = set(catalog.events_for(pipelines or list(catalog.PIPELINE_EVENTS)))
    parts = []

    ev_slots = [(f"event_type = '{t}'", name, i)
                for t, names in EVENT_FANOUT.items() for i, name in enumerate(names) if name in wanted]
    if ev_slots:
        # rows of other types make no line: they are left out before rows are spread and read
        types = sorted({t for t, names in EVENT_FANOUT.items() if wanted & set(names)})
        ev = _read(spark, sf_dir, "events", "event_id").where(F.col("event_type").isin(types)).selectExpr(
            "event_id", "ts", "user_id", "event_type", "value",
            "CAST(get_json_object(props, '$.k') AS INT) AS k",
            "unix_millis(CAST(ts AS TIMESTAMP)) AS ms", "event_id AS __off",
            # what many event types share: their lines' code must stay small enough to be compiled
            "CAST(user_id % 5 AS STRING) AS cluster", "CAST(user_id AS STRING) AS player",
            "date_format(ts, 'yyyyMMdd') AS day")
        parts.append(_fanout(ev, "events", ev_slots, _events_values))

    ord_slots = [("TRUE", name, i) for i, name in enumerate(("SEND_TRANSACTION", "TRANSACTION_RESULT"))
                 if name in wanted]
    if ord_slots:
        orders = _read(spark, sf_dir, "orders", "o_orderkey").selectExpr(
            "*", "unix_millis(CAST(o_orderdate AS TIMESTAMP)) + (o_orderkey % 86400) * 1000 AS send_ms",
            "o_orderkey AS __off")
        parts.append(_fanout(orders, "orders", ord_slots, _orders_values))

    li_slots = [("TRUE", name, i) for i, name in enumerate(("PRODUCT_MOVEMENTS", "BATTLE")) if name in wanted]
    if li_slots:
        li = _read(spark, sf_dir, "lineitem", "l_orderkey").selectExpr(
            "*", "unix_millis(CAST(l_shipdate AS TIMESTAMP)) AS ms", "CAST(l_quantity AS INT) AS q",
            "l_orderkey * 8 + l_linenumber AS __off")
        parts.append(_fanout(li, "lineitem", li_slots, _lineitem_values))

    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# Dimension lines
# ---------------------------------------------------------------------------

def _lines(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(F.concat_ws("|", *[F.col(c).cast("string") for c in cols]).alias("value"))


def dimension_lines(spark: SparkSession, sf_dir: str, dim: str) -> DataFrame:
    """Pipe-delimited source lines of a dimension, built from the small tables."""
    region = lambda: _read(spark, sf_dir, "region")
    nation = lambda: _read(spark, sf_dir, "nation")
    part = lambda: _read(spark, sf_dir, "part")
    if dim in ("cluster", "progress_type", "progress_status", "battle_type", "product_action",
               "transaction_source", "payment_method"):
        return _lines(region(), "r_regionkey", "r_name")
    if dim == "network":
        # nation lines plus supplier lines keyed by nation: duplicate keys resolve to min(name)
        return _lines(nation(), "n_nationkey", "n_name", "n_regionkey").unionByName(
            _lines(_read(spark, sf_dir, "supplier"), "s_nationkey", "s_name"))
    if dim in ("country", "player_action", "movement_source_type"):
        return _lines(nation(), "n_nationkey", "n_name")
    if dim == "device":
        return _lines(part(), "p_brand", "p_partkey", "p_type", "p_size", "p_retailprice", "p_name")
    if dim == "quest":
        return _lines(part(), "p_size", "p_partkey", "p_brand", "p_type")
    if dim == "product":
        return _lines(part(), "p_brand", "p_partkey", "p_name")
    raise KeyError(dim)


def dimensions(spark: SparkSession, sf_dir: str, dims: Iterable[str]) -> dict[str, DataFrame]:
    out = {}
    for d in dims:
        key_idx, name_idx = catalog.DIM_POSITIONS[d]
        out[d] = dimension_from_lines(dimension_lines(spark, sf_dir, d), d, key_idx, name_idx)
    return out


# ---------------------------------------------------------------------------
# Currency rate snapshots
# ---------------------------------------------------------------------------

def rate_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(as_of long, json string)``: one ``{"rates": {...}}`` snapshot per order day.

    Rate of a currency on a day = (orders of its priority that day % 4) / 4;
    USD is 1.  The unmapped priority's currency never gets a rate.  A day's map
    has at most one entry per currency.
    """
    o = _read(spark, sf_dir, "orders")
    currency = F.lit(None).cast("string")
    for p, cur in PRIORITY_CURRENCY.items():
        if cur != "XTS":
            currency = F.when(F.col("o_orderpriority") == p, F.lit(cur)).otherwise(currency)
    per_cur = (o.select(_ms(F.col("o_orderdate")).alias("as_of"), currency.alias("curr"))
               .where(F.col("curr").isNotNull())
               .groupBy("as_of", "curr").agg(F.count(F.lit(1)).alias("n")))
    rate = F.when(F.col("curr") == "USD", F.lit(1.0)).otherwise((F.col("n") % 4) / F.lit(4.0))
    return (per_cur.groupBy("as_of")
            .agg(F.map_from_entries(F.collect_list(F.struct("curr", rate.alias("r")))).alias("m"))
            .select("as_of", F.to_json(F.struct(F.col("m").alias("rates"))).alias("json")))


def daily_rate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipe-delimited daily rate lines ``yyyyMMdd|curr|source|rate`` from the snapshots."""
    from .sources.rates import currency_rates
    snap = currency_rates(rate_snapshots(spark, sf_dir))
    day = F.date_format(F.timestamp_millis("as_of"), "yyyyMMdd")
    return snap.select(F.concat_ws("|", day, F.col("curr"), F.lit("orders"), F.col("us_val").cast("string")).alias("value"))
