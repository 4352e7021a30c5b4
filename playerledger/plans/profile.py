"""E5 profile: the latest user profile per (player, cluster); ties are all kept."""

from pyspark.sql import functions as F

from .. import schema
from ..functions.keys import key_for
from ..operators.latest import latest_per_key
from .base import BASE_SELECT, DocKind, EventPlan, cols


class Profile(EventPlan):
    name = "profile"
    fields = list(schema.USER_PROFILE)

    def prepare(self, df, ctx):
        return latest_per_key(super().prepare(df, ctx), ["player_id", "cluster_id"], "event_ts", ties=True)

    def kinds(self):
        return [DocKind("profile", 1, F.col("event_name") == "USER_PROFILE",
                        cols(schema.USER_PROFILE, BASE_SELECT, extra=[("id", key_for("player_cluster"))]))]
