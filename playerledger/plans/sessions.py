"""E1 sessions: CONNECT / LOGIN / DISCONNECT folded into one session document."""

from pyspark.sql import functions as F

from .. import schema
from ..functions.keys import key_for
from .base import BASE_SELECT, DocKind, EventPlan, cols, datetime_of, week_of


class Sessions(EventPlan):
    name = "sessions"
    fields = schema.union_fields(schema.CONNECT, schema.LOGIN)

    def kinds(self):
        ev = F.col("event_name")
        ident = [("id", key_for("player_session")), ("date_part", week_of())]
        return [
            DocKind("connect", 1, ev == "CONNECT",
                    cols(schema.CONNECT, BASE_SELECT, extra=ident + ["country_name",
                         ("connect_datetime", datetime_of("event_ts"))])),
            DocKind("login", 2, ev == "LOGIN",
                    cols(schema.LOGIN, BASE_SELECT, extra=ident + ["device_name",
                         ("login_datetime", datetime_of("event_ts"))])),
            DocKind("disconnect", 3, ev == "DISCONNECT",
                    [ident[0], ("disconnect_datetime", datetime_of("event_ts")), ident[1], "event_name"]),
        ]
