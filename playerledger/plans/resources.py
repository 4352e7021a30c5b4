"""E8 resources: latest resource balances per (player, cluster), from DISCONNECT."""

from pyspark.sql import functions as F

from .. import schema
from ..functions.keys import key_for
from ..operators.latest import latest_per_key
from .base import BASE_SELECT, DocKind, EventPlan, cols


class Resources(EventPlan):
    name = "resources"
    fields = list(schema.RESOURCES)

    def prepare(self, df, ctx):
        return latest_per_key(super().prepare(df, ctx), ["player_id", "cluster_id"], "event_ts", ties=True)

    def kinds(self):
        return [DocKind("resources", 1, F.col("event_name") == "DISCONNECT",
                        cols(schema.RESOURCES, BASE_SELECT, drop=("event_ts", "event_name"),
                             extra=[("id", key_for("player_cluster"))]))]
