"""Deterministic document ids (P5).

An id is its parts joined by '_'; any null part gives a null id (such rows are
routed to rejects before a keyed merge).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The seven id shapes used by the pipelines.
KEY_SHAPES = {
    "player_session": ("player_id", "session_id"),
    "player_txn": ("player_id", "internal_transaction_id"),
    "player_cluster_session_txn": ("player_id", "cluster_id", "session_id", "internal_transaction_id"),
    "player_cluster": ("player_id", "cluster_id"),
    "player_cluster_ts_order": ("player_id", "cluster_id", "event_ts", "event_order"),
    "player_cluster_session_battle": ("player_id", "cluster_id", "session_id", "battle_id"),
    "player_cluster_quest": ("player_id", "cluster_id", "keyid"),
}


def doc_id(*parts) -> Column:
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit("_"))
        cols.append((F.col(p) if isinstance(p, str) else p).cast("string"))
    return F.concat(*cols)


def key_for(shape: str) -> Column:
    return doc_id(*KEY_SHAPES[shape])
