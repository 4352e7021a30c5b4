"""E11 progress: quest open / start / finish folded into one quest document.

Start events are told apart by their progress type ("2" opens, "3" starts);
other start types write nothing.
"""

from pyspark.sql import functions as F

from .. import schema
from ..functions.keys import key_for
from .base import BASE_SELECT, DocKind, EventPlan, cols, datetime_of, week_of

PROGRESS_SELECT = BASE_SELECT + ("progress_type_name", "progress_status_name", "quest_name")


class Progress(EventPlan):
    name = "progress"
    fields = schema.union_fields(schema.PROGRESS_OPEN, schema.PROGRESS_START, schema.PROGRESS_FINISH)

    def kinds(self):
        ev = F.col("event_name")
        ptype = F.col("progress_type")
        ident = [("date_part", week_of()), ("id", key_for("player_cluster_quest"))]
        return [
            DocKind("open", 1, (ev == "PROGRESS_START") & (ptype == "2"),
                    cols(schema.PROGRESS_OPEN, PROGRESS_SELECT, drop=("event_ts",),
                         extra=[("open_datetime", datetime_of("event_ts"))] + ident)),
            DocKind("start", 2, (ev == "PROGRESS_START") & (ptype == "3"),
                    cols(schema.PROGRESS_START, PROGRESS_SELECT, drop=("event_ts",),
                         extra=[("start_datetime", datetime_of("event_ts"))] + ident)),
            DocKind("finish", 3, ev == "PROGRESS_FINISH",
                    [ident[1], ident[0], ("finish_datetime", datetime_of("event_ts")), "event_name",
                     "event_datetime", "progress_type_name"]),
        ]
