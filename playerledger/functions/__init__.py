"""Column -> Column helpers (P1-P5, P9-P12). All run JVM-side, no Python UDFs."""

from .time import day_key, epoch_ms_to_datetime, event_time, month_part, week_part
from .keys import doc_id, KEY_SHAPES, key_for
from .columns import fill_status, usd_amount
from .sparse import sparse_string_map

__all__ = [
    "day_key", "epoch_ms_to_datetime", "event_time", "month_part", "week_part",
    "doc_id", "KEY_SHAPES", "key_for", "fill_status", "usd_amount",
    "sparse_string_map",
]
