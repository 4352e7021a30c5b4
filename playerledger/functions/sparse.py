"""Sparse string map of the non-null fields of a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sparse_string_map(required: Sequence[tuple[str, Column]], optional: Sequence[str]) -> Column:
    """map<string,string> of required entries plus the non-null optional fields.

    Entries are laid out in key order so the map (and its JSON form) is stable.
    Required entries are always present; optional fields appear only when set.
    """
    entries = [(k, c.cast("string")) for k, c in required]
    entries += [(k, F.col(k).cast("string")) for k in optional]
    entries.sort(key=lambda kv: kv[0])
    required_keys = {k for k, _ in required}
    keys = F.array(*[F.lit(k) for k, _ in entries])
    values = F.array(*[c for _, c in entries])
    full = F.map_from_arrays(keys, values)
    keep = F.array(*[F.lit(k) for k in sorted(required_keys)])
    return F.map_filter(full, lambda k, v: v.isNotNull() | F.array_contains(keep, k))
