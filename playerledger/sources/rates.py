"""Currency rates: snapshot JSON (S4), daily text file (S5), refreshed rates.

Rates are USD values per currency: ``usd = amount / us_val``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import RATE_TTL_MS
from ..functions.time import day_key, event_time

RATES_SCHEMA = "curr string, us_val double"


def currency_rates(snapshots: DataFrame, json_col: str = "json", keep=("as_of",)) -> DataFrame:
    """``{"rates": {"EUR": 0.9, ...}}`` -> rows ``(curr, us_val)`` (plus kept columns)."""
    parsed = F.from_json(F.col(json_col), "rates map<string,double>")
    kept = [c for c in keep if c in snapshots.columns]
    return (snapshots.select(*kept, F.explode(parsed["rates"]).alias("curr", "us_val")))


def daily_currency_rates(lines: DataFrame) -> DataFrame:
    """Pipe-delimited ``day|curr|...|rate`` -> ``(curr_day int, curr, us_val double)``.

    Malformed lines (short, non-numeric day or rate, empty currency) are dropped.
    """
    parts = F.split(F.col("value"), r"\|", -1)
    out = lines.select(
        F.get(parts, 0).try_cast("int").alias("curr_day"),
        F.get(parts, 1).alias("curr"),
        F.get(parts, 3).try_cast("double").alias("us_val"),
    )
    return out.where(F.col("curr_day").isNotNull() & F.col("us_val").isNotNull()
                     & F.col("curr").isNotNull() & (F.col("curr") != ""))


def store_daily_rates(rates: DataFrame, path: str) -> None:
    """Daily rates as a table with a folder a month; months written again are replaced."""
    month = F.floor(F.col("curr_day") / 100).cast("int")
    (rates.withColumn("curr_month", month).hint("rebalance", "curr_month").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("curr_month").parquet(path))


def day_of(ms: str = "event_ts") -> Column:
    """P4 as the number that daily rates are kept by."""
    return day_key(event_time(ms)).try_cast("int")


def rates_of_days(spark: SparkSession, path: str, days: DataFrame) -> DataFrame:
    """``(curr_day, curr, us_val)`` of the months that ``days`` (column ``curr_day``) fall in.

    The months are found as the join runs, and only their folders are read.  A day
    and currency that is listed several times keeps its largest rate.
    """
    stored = spark.read.schema("curr_day int, curr string, us_val double, curr_month int").parquet(path)
    # one row a month: bounded by the calendar
    months = F.broadcast(days.select(F.floor(F.col("curr_day") / 100).cast("int").alias("curr_month")).distinct())
    return stored.join(months, "curr_month", "left_semi").groupBy("curr_day", "curr").agg(F.max("us_val").alias("us_val"))


def newest_snapshot(snapshots: DataFrame, at_ms=None) -> DataFrame:
    """The one snapshot row taken last, at or before ``at_ms`` when that is given."""
    eligible = snapshots if at_ms is None else snapshots.where(F.col("as_of") <= F.lit(at_ms))
    return eligible.orderBy(F.desc("as_of"), F.desc("json")).limit(1)


def latest_rates(snapshots: DataFrame, at_ms=None, ttl_ms: int = RATE_TTL_MS) -> DataFrame:
    """``(curr, us_val, as_of, stale)`` of the newest snapshot at or before ``at_ms``.

    The snapshot row is picked first and only that one is exploded.  A snapshot
    older than the refresh age is used all the same (last known rates), with
    ``stale`` set; without any snapshot the result is empty.  The rows are the
    currencies of one snapshot, so they may be broadcast without a count.
    """
    rates = currency_rates(newest_snapshot(snapshots, at_ms))
    ref = F.col("as_of") if at_ms is None else F.lit(at_ms)
    return rates.select("curr", "us_val", "as_of", ((ref - F.col("as_of")) > ttl_ms).alias("stale"))


def rates_with_refresh(snapshots: Callable[[], DataFrame] | DataFrame, ttl_ms: int = RATE_TTL_MS
                       ) -> Callable[[int | None], DataFrame]:
    """A job's rate provider, batch time (ms) -> ``(curr, us_val, as_of, stale)``.

    ``snapshots`` may be a function that reads them anew for each batch.  Rates
    depend on the batch time alone: a batch run again later, with newer snapshots
    there, gets the same rates.
    """
    def at(batch_time_ms: int | None) -> DataFrame:
        return latest_rates(snapshots() if callable(snapshots) else snapshots, batch_time_ms, ttl_ms)
    return at
