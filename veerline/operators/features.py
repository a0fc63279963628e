"""Daily features per user.

All are one hash aggregation, which Spark splits into a map-side and a final part; a user
with a large share of the events is reduced to a few rows per map task before any row is
shuffled. Exact distinct counts are shuffled by user, day *and value*, so that such a user's
values are spread over all tasks too. ``approx=True`` replaces them by sketches with about 5 %
error; they pay off only where users have very many distinct values a day, as a sketch is
larger than a short list of values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..functions.predicates import is_admin_process, is_internal_ip, is_suspicious_process
from .bounds import Bounds, in_both, period, with_date

# The column sets of the daily network features.
WIDE = (
    "daily_events", "daily_bytes_out", "daily_bytes_in", "daily_packets_out", "daily_packets_in",
    "unique_destinations", "unique_hosts", "unique_ports", "unique_apps",
    "active_hours", "first_activity_hour", "last_activity_hour",
    "avg_session_duration", "max_session_duration",
)
NARROW = (
    "daily_events", "daily_bytes_out", "daily_bytes_in",
    "unique_destinations", "unique_hosts", "unique_ports",
    "active_hours", "first_activity_hour", "last_activity_hour",
)
WIDE_ANALYSIS = (
    "daily_events", "daily_bytes_out", "daily_bytes_in", "unique_destinations", "unique_hosts",
    "active_hours", "first_activity_hour", "last_activity_hour",
)
NARROW_ANALYSIS = (
    "daily_events", "daily_bytes_out", "unique_destinations", "unique_hosts",
    "first_activity_hour", "last_activity_hour",
)
PROCESS = (
    "daily_processes", "unique_processes", "unique_paths", "unique_hosts", "unique_parents",
    "admin_process_count", "suspicious_process_count",
)
PROCESS_ANALYSIS = (
    "daily_processes", "unique_processes", "unique_hosts",
    "admin_process_count", "suspicious_process_count",
)


def _distinct(column: Column | str, approx: bool) -> Column:
    return F.approx_count_distinct(column) if approx else F.count_distinct(column)


def _hours_seen() -> Column:
    """Exact number of distinct hours: a bit per hour, or-ed, with no distinct aggregation."""
    bit = F.call_function("shiftleft", F.lit(1), F.hour("event_time"))
    return F.bit_count(F.bit_or(bit)).cast("bigint")


def network_aggregates(approx: bool = False) -> dict[str, Column]:
    hour = F.hour("event_time")
    return {
        "daily_events": F.count(F.lit(1)),
        "daily_bytes_out": F.sum("bytes_out"),
        "daily_bytes_in": F.sum("bytes_in"),
        "daily_packets_out": F.sum("packets_out"),
        "daily_packets_in": F.sum("packets_in"),
        "unique_destinations": _distinct("dest_ip", approx),
        "unique_hosts": _distinct("dest_host", approx),
        "unique_ports": _distinct("dest_port", approx),
        "unique_apps": _distinct("app_name", approx),
        "active_hours": _hours_seen(),
        "first_activity_hour": F.min(hour),
        "last_activity_hour": F.max(hour),
        "avg_session_duration": F.avg("session_duration"),
        "max_session_duration": F.max("session_duration"),
    }


def process_aggregates(settings: Settings = DEFAULT, approx: bool = False) -> dict[str, Column]:
    suspicious = (
        F.col("is_anomaly") if settings.suspicious_by == "label" else is_suspicious_process(settings=settings)
    )
    return {
        "daily_processes": F.count(F.lit(1)),
        "unique_processes": _distinct("process_name", approx),
        "unique_paths": _distinct("process_path", approx),
        "unique_hosts": _distinct("host", approx),
        "unique_parents": _distinct("parent_process", approx),
        "admin_process_count": F.count_if(is_admin_process(settings=settings)),
        "suspicious_process_count": F.count_if(suspicious),
    }


def _group(events: DataFrame, by: Sequence[str], columns: Sequence[str], aggregates: dict[str, Column]) -> DataFrame:
    return events.groupBy(*by).agg(*[aggregates[c].alias(c) for c in columns])


def daily_network(
    events: DataFrame, columns: Sequence[str] = WIDE, approx: bool = False, by: Sequence[str] = ("user", "date")
) -> DataFrame:
    return _group(with_date(events), by, columns, network_aggregates(approx))


def daily_process(
    events: DataFrame,
    settings: Settings = DEFAULT,
    columns: Sequence[str] = PROCESS,
    approx: bool = False,
    by: Sequence[str] = ("user", "date"),
) -> DataFrame:
    return _group(with_date(events), by, columns, process_aggregates(settings, approx))


def daily_network_periods(
    events: DataFrame,
    bounds: Bounds,
    settings: Settings = DEFAULT,
    columns: Sequence[str] = WIDE,
    approx: bool = False,
) -> DataFrame:
    """Daily features of baseline and analysis from one scan.

    The day on which the analysis starts gives a row in each period.
    """
    events = in_both(events, bounds, settings).withColumn("period", period(bounds))
    return daily_network(events, columns, approx, by=("user", "date", "period"))


def daily_process_periods(
    events: DataFrame,
    bounds: Bounds,
    settings: Settings = DEFAULT,
    columns: Sequence[str] = PROCESS,
    approx: bool = False,
) -> DataFrame:
    events = in_both(events, bounds, settings).withColumn("period", period(bounds))
    return daily_process(events, settings, columns, approx, by=("user", "date", "period"))


def of_period(daily: DataFrame, name: str) -> DataFrame:
    return daily.filter(F.col("period") == name).drop("period")


def labelled_counts(events: DataFrame) -> DataFrame:
    """Labelled anomalies per user-day."""
    return with_date(events).groupBy("user", "date").agg(F.count_if("is_anomaly").alias("known_anomalies"))


def with_geo_features(events: DataFrame) -> DataFrame:
    """Distinct source and destination countries per user-day."""
    return with_date(events).groupBy("user", "date").agg(
        F.count_distinct("src_country").alias("unique_countries"),
        F.count_distinct("dest_country").alias("dest_countries"),
    )


def daily_lateral(events: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Signs of lateral movement per user-day: internal addresses, ports, remote-access hits."""
    internal = F.when(is_internal_ip(settings=settings), F.col("dest_ip"))
    return with_date(events).groupBy("user", "date").agg(
        F.count_distinct(internal).alias("internal_destinations"),
        F.count_distinct("dest_port").alias("unique_ports"),
        *[
            F.count_if(F.col("dest_port") == port).alias(f"port_{port}_events")
            for port in settings.lateral_ports
        ],
    )
