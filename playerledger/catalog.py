"""Pipeline registry: event names, dimensions, target tables and dimension keys.

These are configuration values of the event feed; they are stated plainly so a
job can be assembled from pipeline names alone.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Which raw event names each pipeline consumes.
# ---------------------------------------------------------------------------
PIPELINE_EVENTS = {
    "sessions": ("CONNECT", "LOGIN", "DISCONNECT"),
    "deposits": ("SEND_TRANSACTION", "TRANSACTION_RESULT"),
    "trigger": ("DEPOSIT_TRIGGER",),
    "userGameProfile": ("USER_GAME_PROFILE",),
    "profile": ("USER_PROFILE",),
    "regs": ("REGISTRATION",),
    "set_level": ("SET_LEVEL",),
    "resources": ("DISCONNECT",),
    "prodMove": ("PRODUCT_MOVEMENTS",),
    "battle": ("BATTLE",),
    "progress": ("PROGRESS_START", "PROGRESS_FINISH"),
}

# ---------------------------------------------------------------------------
# Dimensions each pipeline needs (joined only when needed).
# ---------------------------------------------------------------------------
PIPELINE_DIMS = {
    "sessions": ("cluster", "network", "country", "device"),
    "deposits": ("cluster", "network", "payment_method", "transaction_source"),
    "trigger": ("cluster", "network", "player_action", "product"),
    "userGameProfile": (),
    "profile": ("cluster", "network"),
    "regs": ("cluster", "network"),
    "set_level": ("cluster", "network"),
    "resources": ("cluster", "network"),
    "prodMove": ("cluster", "network", "product_action", "movement_source_type"),
    "battle": ("cluster", "network", "battle_type"),
    "progress": ("cluster", "network", "progress_type", "progress_status", "quest"),
}

# ---------------------------------------------------------------------------
# Target document table per pipeline and whether the table is
# split by a date part ("week", "month") or not (None).  Four pipelines share
# the player profile table.
# ---------------------------------------------------------------------------
PIPELINE_TABLE = {
    "sessions": ("sessions", "week"),
    "deposits": ("deposits", "month"),
    "trigger": ("deposit_trigger", "month"),
    "userGameProfile": ("player_profile", None),
    "profile": ("player_profile", None),
    "regs": ("player_profile", None),
    "set_level": ("player_profile", None),
    "resources": ("resources", None),
    "prodMove": ("prodmovements", "week"),
    "battle": ("battle", "week"),
    "progress": ("progress", "week"),
}

# All pipelines upsert by document id today; "append" is the other mode.
PIPELINE_MODE = {name: "update" for name in PIPELINE_EVENTS}

# ---------------------------------------------------------------------------
# Fact column joined to each dimension, and the positions of
# (key, name) in the dimension's pipe-delimited line.
# ---------------------------------------------------------------------------
DIM_FACT_KEY = {
    "cluster": "cluster_id",
    "network": "network_id",
    "progress_type": "progress_type",
    "progress_status": "state",
    "product": "item_id",
    "player_action": "action_id",
    "battle_type": "battle_type_id",
    "country": "login_country_id",
    "device": "device_desc",
    "product_action": "product_action_id",
    "movement_source_type": "movement_source_id",
    "payment_method": "payment_method_id",
    "transaction_source": "transaction_source_id",
    "quest": "keyid",
}

DIM_POSITIONS = {
    "cluster": (0, 1),
    "network": (0, 1),
    "country": (0, 1),
    "device": (1, 5),
    "quest": (1, 3),
    "progress_type": (0, 1),
    "progress_status": (0, 1),
    "product": (1, 2),
    "player_action": (0, 1),
    "battle_type": (0, 1),
    "product_action": (0, 1),
    "movement_source_type": (0, 1),
    "transaction_source": (0, 1),
    "payment_method": (0, 1),
}

# Rates older than this are refreshed (12 hours, in milliseconds).
RATE_TTL_MS = 43_200_000

# A table without a date split stores its documents under this partition value.
NO_DATE_PART = "all"


def events_for(pipelines) -> list[str]:
    seen: dict[str, None] = {}
    for p in pipelines:
        for e in PIPELINE_EVENTS[p]:
            seen.setdefault(e, None)
    return list(seen)


def dims_for(pipelines) -> list[str]:
    seen: dict[str, None] = {}
    for p in pipelines:
        for d in PIPELINE_DIMS[p]:
            seen.setdefault(d, None)
    return list(seen)
