"""E4 userGameProfile: sparse document of the set game-profile fields."""

from pyspark.sql import functions as F

from .. import schema
from ..functions.keys import key_for
from ..functions.sparse import sparse_string_map
from .base import DocKind, EventPlan

# Always written; every other game-profile field only when set.
REQUIRED = ("id", "event_datetime", "player_id", "event_name", "cluster_id")
OPTIONAL = tuple(n for n, _ in schema.GAME_PROFILE if n not in REQUIRED and n != "event_ts")


class GameProfile(EventPlan):
    name = "userGameProfile"
    fields = list(schema.GAME_PROFILE)

    def kinds(self):
        required = [("id", key_for("player_cluster"))] + [(c, F.col(c)) for c in REQUIRED[1:]]
        doc = sparse_string_map(required, list(OPTIONAL))
        return [DocKind("game_profile", 1, F.col("event_name") == "USER_GAME_PROFILE",
                        [("id", key_for("player_cluster")), ("doc", doc)])]

    def documents(self, changes):
        """The map's entries as string columns: an absent entry is null and overwrites nothing."""
        entries = [F.col("doc").getItem(k).alias(k) for k in (*REQUIRED[1:], *OPTIONAL)]
        return changes.select("id", *entries, *[c for c in changes.columns if c not in ("id", "doc")])
