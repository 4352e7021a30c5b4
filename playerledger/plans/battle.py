"""E10 battle: one document per battle participation."""

from pyspark.sql import functions as F

from .. import schema
from ..functions.keys import key_for
from .base import BASE_SELECT, DocKind, EventPlan, cols, week_of


class Battle(EventPlan):
    name = "battle"
    fields = list(schema.BATTLE)

    def kinds(self):
        return [DocKind("battle", 1, F.col("event_name") == "BATTLE",
                        cols(schema.BATTLE, BASE_SELECT, ["battle_type_name"], drop=("event_name", "event_ts"),
                             extra=[("date_part", week_of()), ("id", key_for("player_cluster_session_battle"))]))]
