"""E2 deposits: a transaction and its status changes folded into one document.

The send event carries the offer; each result status writes its own time
field.  A missing status counts as approved (-1).  Statuses outside
{-1, 1..5} write nothing.  USD amount = amount / rate of the currency (null
for an unknown currency or a zero rate).
"""

from pyspark.sql import functions as F

from .. import schema
from ..functions.columns import fill_status, usd_amount
from ..functions.keys import key_for
from ..operators.enrich import join_daily_rates, join_rates
from ..sources.rates import RATES_SCHEMA, day_of
from .base import BASE_SELECT, DocKind, EventPlan, cols, month_of

# Fields the approved-status document leaves out (so it cannot blank them).
APPROVED_DROPS = ("original_offer_amount", "payment_method_id", "bonus_amount_1", "bonus_amount_2",
                  "receive_amount_1")

# Fixed values: (status id, time field, write rank) of the other result documents.
STATUS_DOCS = ((2, "refused_status_time", 3), (3, "canceled_status_time", 4),
               (4, "pending_status_time", 5), (5, "error_status_time", 6))

# What every status document has: the common fields without the raw time, the names
# of the base lookups, the transaction and its status.
STATUS_COLUMNS = [c for c in schema.names(schema.BASE, BASE_SELECT, ["event_datetime", "internal_transaction_id",
                                                                     "transaction_status_id"]) if c != "event_ts"]


class Deposits(EventPlan):
    name = "deposits"
    fields = schema.union_fields(schema.DEPOSIT, schema.SEND_DEPOSIT_EXTRA)

    def prepare(self, df, ctx):
        rows = super().prepare(df, ctx)
        if ctx.daily_rates is not None:
            rows = join_daily_rates(rows, ctx.daily_rates, day_of()).drop("curr_day")
        else:
            rows = join_rates(rows, ctx.rates if ctx.rates is not None else rows.sparkSession.createDataFrame([], RATES_SCHEMA))
        rows = (rows.withColumn("usd_deposit", usd_amount("deposit_amount", "us_val")).drop("us_val"))
        return fill_status(rows)

    def kinds(self):
        ev = F.col("event_name")
        status = F.col("transaction_status_id")
        result = ev == "TRANSACTION_RESULT"
        send_cols = cols(self.fields, BASE_SELECT, ["payment_method_name", "transaction_source_name"],
                         extra=[("id", key_for("player_txn")), ("date_part", month_of()), "usd_deposit"])
        approved = [c for c in send_cols if (c[0] if isinstance(c, tuple) else c) not in APPROVED_DROPS]
        approved.append(("Approved_status_time", F.col("event_datetime")))
        out = [
            DocKind("send", 1, ev == "SEND_TRANSACTION", send_cols),
            DocKind("approved", 2, result & status.isin(1, -1), approved),
        ]
        for sid, time_col, rank in STATUS_DOCS:
            spec = [*STATUS_COLUMNS, ("id", key_for("player_txn")), ("date_part", month_of()),
                    (time_col, F.col("event_datetime"))]
            out.append(DocKind(time_col.split("_")[0], rank, result & (status == sid), spec))
        return out
