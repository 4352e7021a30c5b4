"""Time helpers over epoch-millisecond longs.

The datetime string keeps whole seconds only (``.000`` suffix): the epoch value
is divided by 1000 and truncated toward zero before formatting.  Date parts are
taken from the same truncated second so they always agree with the string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _seconds(ms) -> Column:
    # long division truncates toward zero, like a double->long cast of ms/1000
    return (_col(ms) / F.lit(1000)).cast("long")


def event_time(ms) -> Column:
    """Timestamp of the truncated second of an epoch-ms value."""
    return F.timestamp_seconds(_seconds(ms))


def epoch_ms_to_datetime(ms) -> Column:
    """Epoch ms -> 'yyyy-MM-dd HH:mm:ss.SSS' string (sub-second part is 000)."""
    return F.from_unixtime(_seconds(ms), DATETIME_FORMAT)


def week_part(ts) -> Column:
    """Calendar year + '_' + ISO week number, no padding (2016-01-01 -> 2016_53)."""
    t = _col(ts)
    return F.concat(F.year(t).cast("string"), F.lit("_"), F.weekofyear(t).cast("string"))


def month_part(ts) -> Column:
    """P3: 'yyyy-MM'."""
    return F.date_format(_col(ts), "yyyy-MM")


def day_key(ts) -> Column:
    """P4: 'yyyyMMdd' (join key of daily rates)."""
    return F.date_format(_col(ts), "yyyyMMdd")
