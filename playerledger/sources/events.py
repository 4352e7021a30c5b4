"""Raw JSON event lines: stream source (S1), prefilters (F1, F4), typed parse.

A raw event frame has the envelope ``value string, topic string, partition int,
offset long``: the Kafka record layout.  File and archive sources fill topic,
partition and offset with nulls; ``value`` is one JSON object.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema

ENVELOPE = ("value", "topic", "partition", "offset")
CORRUPT_COLUMN = "_corrupt_record"


def to_envelope(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project any frame with a ``value`` column to the raw-event envelope."""
    cols = set(df.columns)
    return df.select(
        F.col("value").cast("string").alias("value"),
        (F.col("topic").cast("string") if "topic" in cols else F.lit(None).cast("string")).alias("topic"),
        (F.col("partition").cast("int") if "partition" in cols else F.lit(None).cast("int")).alias("partition"),
        (F.col("offset").cast("long") if "offset" in cols else F.lit(None).cast("long")).alias("offset"),
        *keep,
    )


def json_event_stream(spark: SparkSession, source: Mapping[str, str], max_per_trigger: int | None = None,
                      repartition: int | None = None) -> DataFrame:
    """Streaming frame of raw events.

    ``source`` is ``{"format": "kafka", "kafka.bootstrap.servers": ..., "subscribe": ...}``
    for a broker, or ``{"format": "text" | "parquet" | "json", "path": ...}`` for a
    directory of files (what tests and replays use).  The Kafka key is dropped.
    """
    opts = dict(source)
    fmt = opts.pop("format")
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        df = reader.options(**opts).load()
    else:
        path = opts.pop("path")
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        if fmt in ("parquet", "json"):
            reader = reader.schema(opts.pop("schema", "value string, topic string, partition int, offset long"))
        df = reader.options(**opts).load(path)
    df = to_envelope(df)
    if repartition:
        df = df.repartition(repartition)
    return df


def event_name_of(value_col="value"):
    return F.get_json_object(F.col(value_col), "$.event_name")


def prefilter_event_names(df: DataFrame, names: Iterable[str], name_col: str | None = None) -> DataFrame:
    """keep raw lines whose JSON ``event_name`` is one of ``names``.

    Runs on the raw string before the full typed parse; lines that are not JSON
    or have no string ``event_name`` never match.  The name is kept as ``name_col``
    when that is given: no filter is pushed below a generator, so each line is read once.
    """
    if name_col is None:
        return df.where(event_name_of().isin(list(names)))
    return df.select("*", F.explode(F.array(event_name_of())).alias(name_col)).where(F.col(name_col).isin(list(names)))


def prefilter_product_action(df: DataFrame, action_id: int = 3) -> DataFrame:
    """keep raw lines whose JSON ``product_action_id`` equals ``action_id``."""
    return df.where(F.get_json_object(F.col("value"), "$.product_action_id").try_cast("int") == action_id)


def dead_letters(df: DataFrame) -> DataFrame:
    """Raw lines that cannot be routed: not JSON, or no usable ``event_name``."""
    return df.where(event_name_of().isNull())


def parse_events(df: DataFrame, fields: Iterable[tuple[str, str]], keep_corrupt: bool = True,
                 only: Iterable[str] | None = None) -> DataFrame:
    """Typed wide row from the JSON ``value`` with the declared union schema.

    Permissive: a field of the wrong type becomes null and the raw line is kept
    in ``_corrupt_record``; unknown fields are ignored.  Envelope columns are kept.
    With ``only`` just these fields come out, of lines checked for all ``fields``.
    """
    fields = list(fields)
    if only is not None:
        only = list(only)
        # any value reads as a string, so a string field that is not asked for needs no parse;
        # without the corrupt column no other field needs one either
        fields = [(n, k) for n, k in fields if n in only or (keep_corrupt and k != "string")]
    st = schema.struct_type(fields)
    if keep_corrupt:
        st = st.add(T.StructField(CORRUPT_COLUMN, T.StringType(), True))
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    envelope = [c for c in ("topic", "partition", "offset", "__pos", "__batch") if c in df.columns]
    # ``inline`` makes the parsed fields generator output: a later filter on a
    # parsed field cannot be pushed below it, so each line is parsed once
    # (a plain projection would be inlined into the filter and parse twice).
    rows = F.array(F.from_json(F.col("value"), st, opts))
    if only is not None:
        out = [f.name for f in st if f.name in only or f.name == CORRUPT_COLUMN]
        if len(out) < len(st):
            rows = F.transform(rows, lambda r: F.struct(*[r[n].alias(n) for n in out]))
    return df.select(F.inline(rows), *envelope)
