"""E7 set_level: latest main (type 1) and secondary (type 2) level per player."""

from pyspark.sql import functions as F

from .. import schema
from ..functions.keys import key_for
from ..operators.latest import latest_per_key
from .base import DocKind, EventPlan

LEVEL_KINDS = ((1, "main_level"), (2, "Secondary_level"))


class SetLevel(EventPlan):
    name = "set_level"
    fields = list(schema.SET_LEVEL)

    def prepare(self, df, ctx):
        rows = super().prepare(df, ctx).where(F.col("level_type_id").isin(1, 2))
        # one window for both level types: the type is part of the key
        return latest_per_key(rows, ["player_id", "cluster_id", "level_type_id"], "event_ts", ties=True)

    def kinds(self):
        t = F.col("level_type_id")
        return [DocKind(target, lvl, t == lvl,
                        [(target, F.col("level_id")), ("id", key_for("player_cluster")), "event_name"])
                for lvl, target in LEVEL_KINDS]
