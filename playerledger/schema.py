"""Declared event schemas (P6 / S7 parameters).

Every event field is nullable and has one of four types: string, long, int,
double.  A pipeline reads the union of the field lists it needs; the union of
any combination is conflict free (no field is declared with two types).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
}


# ---------------------------------------------------------------------------
# Event field lists (name, type).
# They must equal the producer's event layout, so they are stated verbatim.
# ---------------------------------------------------------------------------
BASE = (
    ("cluster_id", "string"),
    ("player_id", "string"),
    ("event_ts", "long"),
    ("session_id", "string"),
    ("event_name", "string"),
    ("network_id", "int"),
)

CONNECT = BASE + (
    ("login_country_id", "string"),
)

LOGIN = BASE + (
    ("device_desc", "string"),
    ("device_id", "string"),
    ("os_version", "string"),
    ("linked_player_id", "string"),
    ("timezone", "string"),
    ("game_version", "string"),
)

DEPOSIT = BASE + (
    ("internal_transaction_id", "string"),
    ("offer_id", "string"),
    ("deposit_amount", "double"),
    ("deposit_currency", "string"),
    ("transaction_source_id", "int"),
    ("external_transaction_id", "string"),
    ("transaction_status_id", "int"),
    ("bonus_amount_1", "int"),
    ("bonus_amount_2", "int"),
    ("receive_amount_1", "int"),
)

SEND_DEPOSIT_EXTRA = (
    ("original_offer_amount", "double"),
    ("payment_method_id", "int"),
)

TRIGGER = BASE + (
    ("internal_transaction_id", "string"),
    ("item_id", "string"),
    ("item_name", "string"),
    ("action_id", "int"),
    ("trigger_group_type", "string"),
    ("trigger_group_type_id", "string"),
    ("trigger_id", "string"),
    ("trigger_type", "string"),
)

PROGRESS_OPEN = BASE + (
    ("keyid", "string"),
    ("category_type", "string"),
    ("category_id", "string"),
    ("sub_category_id", "string"),
    ("sub_category_type", "string"),
    ("keyname", "string"),
    ("progress_type", "string"),
    ("start_rate", "string"),
)

PROGRESS_START = BASE + (
    ("progress_type", "string"),
    ("keyid", "string"),
    ("category_type", "string"),
    ("category_id", "string"),
    ("sub_category_id", "string"),
    ("sub_category_type", "string"),
    ("keyname", "string"),
)

PROGRESS_FINISH = (
    ("cluster_id", "string"),
    ("player_id", "string"),
    ("event_ts", "long"),
    ("session_id", "string"),
    ("event_name", "string"),
    ("keyid", "string"),
    ("state", "int"),
    ("finish_rate", "string"),
    ("progress_type", "string"),
)

USER_PROFILE = (
    ("event_name", "string"),
    ("event_ts", "long"),
    ("cluster_id", "string"),
    ("network_id", "int"),
    ("player_id", "string"),
    ("social_id", "string"),
    ("attribute1", "string"),
    ("attribute2", "string"),
    ("attribute3", "string"),
    ("birthday", "long"),
    ("email", "string"),
    ("first_name", "string"),
    ("last_name", "string"),
    ("gender", "string"),
    ("ingame_friends", "int"),
    ("language", "string"),
    ("num_friends", "int"),
    ("url_picture", "string"),
)

GAME_PROFILE = (
    ("event_name", "string"),
    ("event_ts", "long"),
    ("cluster_id", "string"),
    ("player_id", "string"),
    ("base_name", "string"),
    ("game_language_id", "string"),
    ("game_world_id", "int"),
    ("is_test_player", "int"),
    ("is_vip", "int"),
    ("location_x", "int"),
    ("location_y", "int"),
    ("user_name", "string"),
)

SET_LEVEL = (
    ("event_name", "string"),
    ("network_id", "int"),
    ("event_ts", "long"),
    ("cluster_id", "string"),
    ("player_id", "string"),
    ("level_type_id", "int"),
    ("new_level_ind", "int"),
    ("level_id", "int"),
)

REGISTRATION = (
    ("event_name", "string"),
    ("network_id", "int"),
    ("event_ts", "long"),
    ("registration_date", "long"),
    ("cluster_id", "string"),
    ("player_id", "string"),
    ("login_source_id", "string"),
    ("login_source_type_id", "string"),
)

RESOURCES = (
    ("event_name", "string"),
    ("event_ts", "long"),
    ("cluster_id", "string"),
    ("network_id", "int"),
    ("player_id", "string"),
    ("resource1_id", "string"),
    ("resource10_id", "string"),
    ("resource2_id", "string"),
    ("resource3_id", "string"),
    ("resource4_id", "string"),
    ("resource5_id", "string"),
    ("resource6_id", "string"),
    ("resource7_id", "string"),
    ("resource8_id", "string"),
    ("resource9_id", "string"),
    ("resource_amount_1", "int"),
    ("resource_amount_10", "double"),
    ("resource_amount_2", "int"),
    ("resource_amount_3", "int"),
    ("resource_amount_4", "int"),
    ("resource_amount_5", "int"),
    ("resource_amount_6", "int"),
    ("resource_amount_7", "int"),
    ("resource_amount_8", "int"),
    ("resource_amount_9", "double"),
)

PRODUCT_MOVEMENTS = (
    ("event_name", "string"),
    ("event_ts", "long"),
    ("event_order", "int"),
    ("cluster_id", "string"),
    ("network_id", "int"),
    ("player_id", "string"),
    ("product_action_id", "int"),
    ("product_id", "string"),
    ("product_name", "string"),
    ("product_count", "int"),
    ("bonus_amount", "int"),
    ("bonus_product_id", "int"),
    ("movement_source_id", "string"),
    ("movement_source_type_id", "string"),
    ("package_id", "string"),
    ("player_target_id", "string"),
    ("payment_product_id_1", "string"),
    ("payment_product_id_2", "string"),
    ("payment_product_id_3", "string"),
    ("payment_product_id_4", "string"),
    ("payment_product_id_5", "string"),
    ("payment_product_id_6", "string"),
    ("payment_product_id_7", "string"),
    ("payment_product_id_8", "string"),
    ("payment_product_name_1", "string"),
    ("payment_product_name_2", "string"),
    ("payment_product_name_3", "string"),
    ("payment_product_name_4", "string"),
    ("payment_product_name_5", "string"),
    ("payment_product_name_6", "string"),
    ("payment_product_name_7", "string"),
    ("payment_product_name_8", "string"),
    ("payment_amount_1", "int"),
    ("payment_amount_2", "int"),
    ("payment_amount_3", "int"),
    ("payment_amount_4", "int"),
    ("payment_amount_5", "int"),
    ("payment_amount_6", "int"),
    ("payment_amount_7", "int"),
    ("payment_amount_8", "int"),
)

BATTLE = (
    ("event_name", "string"),
    ("event_ts", "long"),
    ("cluster_id", "string"),
    ("network_id", "int"),
    ("player_id", "string"),
    ("session_id", "string"),
    ("attacker_ind", "int"),
    ("battle_id", "string"),
    ("battle_source_id", "string"),
    ("battle_type_id", "int"),
    ("base_id", "string"),
    ("base_level", "int"),
    ("base_status_id", "int"),
    ("base_type_id", "int"),
    ("battle_win_ind", "int"),
    ("actual_travel_time", "int"),
    ("main_attacker_ind", "int"),
    ("main_defender_ind", "int"),
    ("opponent_id", "string"),
    ("player_base_ind", "int"),
    ("player_defence_power", "int"),
    ("player_health_power", "int"),
    ("player_offence_power", "int"),
    ("is_offline_action", "int"),
)

# Columns every enriched row carries next to the parsed fields.
BASE_SELECT = ("network_name", "cluster_name", "event_datetime")


def names(*lists: Iterable) -> list[str]:
    """Ordered, de-duplicated column names from field lists and plain names."""
    seen: dict[str, None] = {}
    for lst in lists:
        for item in lst:
            name = item[0] if isinstance(item, tuple) else item
            seen.setdefault(name, None)
    return list(seen)


def union_fields(*lists: Iterable[tuple[str, str]]) -> list[tuple[str, str]]:
    """Union of field lists; a name declared with two types is an error."""
    out: dict[str, str] = {}
    for lst in lists:
        for name, kind in lst:
            prev = out.setdefault(name, kind)
            if prev != kind:
                raise ValueError(f"field {name} declared as {prev} and {kind}")
    return list(out.items())


def struct_type(fields: Iterable[tuple[str, str]]) -> T.StructType:
    """Nullable StructType for a field list (the declared parse schema)."""
    return T.StructType([T.StructField(n, _TYPES[k], True) for n, k in fields])


ALL_FIELDS = union_fields(
    BASE, CONNECT, LOGIN, DEPOSIT, SEND_DEPOSIT_EXTRA, TRIGGER, PROGRESS_OPEN,
    PROGRESS_START, PROGRESS_FINISH, USER_PROFILE, GAME_PROFILE, SET_LEVEL,
    REGISTRATION, RESOURCES, PRODUCT_MOVEMENTS, BATTLE)
FIELD_KIND = dict(ALL_FIELDS)
