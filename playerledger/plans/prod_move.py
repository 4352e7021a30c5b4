"""E9 prodMove: one document per product movement."""

from pyspark.sql import functions as F

from .. import schema
from ..functions.keys import key_for
from .base import BASE_SELECT, DocKind, EventPlan, cols, week_of


class ProdMove(EventPlan):
    name = "prodMove"
    fields = list(schema.PRODUCT_MOVEMENTS)

    def kinds(self):
        return [DocKind("movement", 1, F.col("event_name") == "PRODUCT_MOVEMENTS",
                        cols(schema.PRODUCT_MOVEMENTS, BASE_SELECT,
                             ["movement_source_type_name", "product_action_name"],
                             drop=("event_name", "event_order", "event_ts"),
                             extra=[("date_part", week_of()), ("id", key_for("player_cluster_ts_order"))]))]
