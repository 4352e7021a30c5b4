"""Relational operators: enrichment joins, latest-per-key, keyed document merge."""

from .broadcast import checked_broadcast, MAX_BROADCAST_BYTES
from .enrich import add_event_columns, enrich_with_dims, join_daily_rates, join_rates
from .latest import latest_per_key, max_per_key
from .merge import hot_keys, merge_documents, seq_column, unfolded
from .metrics import observed_count

__all__ = [
    "checked_broadcast", "MAX_BROADCAST_BYTES", "add_event_columns", "enrich_with_dims", "join_daily_rates", "join_rates",
    "latest_per_key", "max_per_key", "hot_keys", "merge_documents", "seq_column", "unfolded",
    "observed_count",
]
