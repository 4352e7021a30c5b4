"""E6 regs: one registration document per player."""

from pyspark.sql import functions as F

from .. import schema
from ..functions.keys import key_for
from .base import BASE_SELECT, DocKind, EventPlan, cols, datetime_of


class Regs(EventPlan):
    name = "regs"
    fields = list(schema.REGISTRATION)

    def kinds(self):
        return [DocKind("registration", 1, F.col("event_name") == "REGISTRATION",
                        cols(schema.REGISTRATION, BASE_SELECT, drop=("event_ts", "registration_date"),
                             extra=[("reg_datetime", datetime_of("registration_date")),
                                    ("id", key_for("player_cluster"))]))]
