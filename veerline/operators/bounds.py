"""The analysis window, the baseline window before it, and filters for both."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, Settings

NAMES = ("baseline_start", "analysis_start", "analysis_end")


@dataclass(frozen=True)
class Bounds:
    """Resolved instants, as text in the session time zone.

    Literals, not a joined row: only literals of the column's own type reach the parquet
    reader as pushed filters.
    """

    baseline_start: str
    analysis_start: str
    analysis_end: str
    data_type: T.DataType

    def literal(self, name: str) -> Column:
        return F.lit(getattr(self, name)).cast(self.data_type)


def time_bounds(events: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One row: start of the baseline, start of the analysis, last event."""
    end = F.max("event_time")
    days = F.make_dt_interval(F.lit(settings.analysis_days))
    more = F.make_dt_interval(F.lit(settings.analysis_days + settings.baseline_days))
    row = events.agg(end.alias("analysis_end")).select(
        (F.col("analysis_end") - more).alias("baseline_start"),
        (F.col("analysis_end") - days).alias("analysis_start"),
        "analysis_end",
    )
    if settings.align_to_day:
        data_type = events.schema["event_time"].dataType
        row = row.withColumns(
            {n: F.date_trunc("day", F.col(n)).cast(data_type) for n in NAMES[:2]}
        )
    return row


def resolve_bounds(events: DataFrame, settings: Settings = DEFAULT) -> Bounds:
    """Fetch the one row of ``time_bounds``.

    With a partition column only the last partition is searched for the last event.
    """
    if settings.partition_column:
        day = F.col(settings.partition_column)
        last = events.agg(F.max(day).alias("d")).first()["d"]
        events = events.filter(day == F.lit(last))
    row = time_bounds(events, settings).select(*[F.col(n).cast("string") for n in NAMES]).first()
    if row["analysis_end"] is None:
        raise ValueError("no events to analyse")
    return Bounds(*[row[n] for n in NAMES], events.schema["event_time"].dataType)


def _between(events: DataFrame, bounds: Bounds, start: str, end: str, closed: bool, settings: Settings) -> DataFrame:
    time = F.col("event_time")
    upper = time <= bounds.literal(end) if closed else time < bounds.literal(end)
    condition = (time >= bounds.literal(start)) & upper
    if settings.partition_column:
        day = F.col(settings.partition_column)
        condition &= day.between(
            F.to_date(bounds.literal(start)), F.to_date(bounds.literal(end))
        )
    return events.filter(condition)


def in_baseline(events: DataFrame, bounds: Bounds, settings: Settings = DEFAULT) -> DataFrame:
    """Events of the baseline; its end belongs to the analysis."""
    return _between(events, bounds, "baseline_start", "analysis_start", False, settings)


def in_analysis(events: DataFrame, bounds: Bounds, settings: Settings = DEFAULT) -> DataFrame:
    """Events of the analysis, both ends included."""
    return _between(events, bounds, "analysis_start", "analysis_end", True, settings)


def in_both(events: DataFrame, bounds: Bounds, settings: Settings = DEFAULT) -> DataFrame:
    return _between(events, bounds, "baseline_start", "analysis_end", True, settings)


def period(bounds: Bounds) -> Column:
    """``baseline`` or ``analysis``, for events within the bounds."""
    return F.when(F.col("event_time") < bounds.literal("analysis_start"), "baseline").otherwise("analysis")


def with_date(events: DataFrame) -> DataFrame:
    return events.withColumn("date", F.to_date("event_time"))


def period_counts(events: DataFrame, bounds: Bounds, settings: Settings = DEFAULT) -> DataFrame:
    """One row: events in the baseline and in the analysis, counted in one pass."""
    named = in_both(events, bounds, settings).select(period(bounds).alias("period"))
    return named.agg(
        F.count_if(F.col("period") == "baseline").alias("baseline_events"),
        F.count_if(F.col("period") == "analysis").alias("analysis_events"),
    )
