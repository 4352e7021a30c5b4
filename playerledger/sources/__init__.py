"""Sources and ingest: event streams, archives, dimensions, currency rates."""

from .events import (
    ENVELOPE, CORRUPT_COLUMN, json_event_stream, parse_events, prefilter_event_names,
    prefilter_product_action, dead_letters,
)
from .archive import archive_numbers, archive_range_scan
from .dims import dimension_from_lines, load_dimension, dimension_rejects
from .rates import (
    currency_rates, daily_currency_rates, day_of, latest_rates, newest_snapshot, rates_of_days, rates_with_refresh,
    store_daily_rates,
)
from .audit import offset_audit, source_ranges, total_messages

__all__ = [
    "ENVELOPE", "CORRUPT_COLUMN", "json_event_stream", "parse_events", "prefilter_event_names",
    "prefilter_product_action", "dead_letters", "archive_range_scan", "dimension_from_lines",
    "load_dimension", "dimension_rejects", "currency_rates", "daily_currency_rates",
    "latest_rates", "newest_snapshot", "rates_with_refresh", "offset_audit", "total_messages",
    "archive_numbers", "source_ranges", "day_of", "rates_of_days", "store_daily_rates",
]
