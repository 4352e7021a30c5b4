"""E3 trigger: one document per deposit trigger."""

from pyspark.sql import functions as F

from .. import schema
from ..functions.keys import key_for
from .base import BASE_SELECT, DocKind, EventPlan, cols, month_of


class Trigger(EventPlan):
    name = "trigger"
    fields = list(schema.TRIGGER)

    def kinds(self):
        return [DocKind("trigger", 1, F.col("event_name") == "DEPOSIT_TRIGGER",
                        cols(schema.TRIGGER, BASE_SELECT, ["player_action_name", "product_name"],
                             drop=("event_ts", "event_name"),
                             extra=[("date_part", month_of()), ("id", key_for("player_cluster_session_txn"))]))]
