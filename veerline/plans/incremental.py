"""Daily features kept from run to run: a run reads the events of new days only.

The store has one row per user and day, partitioned by day. A baseline over any window of whole days is an
aggregation of its rows; no event of an earlier day is read again.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..operators import features
from ..operators.baseline import rolling_as_baseline, user_baseline_network
from ..operators.bounds import resolve_bounds
from ..operators.scores import network_score


def stored_days(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored user-days; None before the first run."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _day(settings: Settings):
    return F.col(settings.partition_column) if settings.partition_column else F.to_date("event_time")


def refresh_days(events: DataFrame, path: str, settings: Settings = DEFAULT, again: int = 1) -> list[date]:
    """Bring the stored user-days up to date; returns the days that were computed.

    Computed are the days of baseline and analysis that are not stored, and the last ``again`` stored days, which may
    have been cut or have got late events. Only these days of ``events`` are read, as whole partitions where
    ``settings.partition_column`` says so, and only they are replaced, so a repeated run gives the same store.
    """
    spark = events.sparkSession
    bounds = resolve_bounds(events, settings)
    last = date.fromisoformat(bounds.analysis_end[:10])
    first = last - timedelta(days=settings.analysis_days + settings.baseline_days)
    known = stored_days(spark, path)
    # Dates of partitions: no file of the store is read for them.
    have = sorted(r["date"] for r in known.select("date").distinct().collect()) if known is not None else []
    kept = set(have[: len(have) - again]) if again else set(have)
    wanted = [d for i in range((last - first).days + 1) if (d := first + timedelta(days=i)) not in kept]
    if wanted:
        new = events.filter(_day(settings).isin(wanted))
        if settings.partition_column != "date":
            new = new.filter(F.to_date("event_time").isin(wanted))
        daily = features.daily_network(new)
        writer = daily.repartitionByRange("date", "user").write.mode("overwrite").partitionBy("date")
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return wanted


def baseline_of_days(daily: DataFrame, start: date, end: date) -> DataFrame:
    """The network baseline of the stored days from ``start`` up to, not including, ``end``."""
    return user_baseline_network(daily.filter((F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(end))))


def rolling_scores(daily: DataFrame, settings: Settings = DEFAULT, start: date | None = None) -> DataFrame:
    """Every user-day from ``start`` scored against the days before it, which are all that is read of the store."""
    if start is not None:
        daily = daily.filter(F.col("date") >= F.lit(start - timedelta(days=settings.baseline_days)))
    scored = network_score(rolling_as_baseline(daily, settings.baseline_days), settings)
    return scored if start is None else scored.filter(F.col("date") >= F.lit(start))
