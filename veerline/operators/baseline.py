"""User baselines from daily features.

The input has one row per user and day, so that no user has more rows than the window has
days, however many events lie behind them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def user_baseline_network(daily: DataFrame) -> DataFrame:
    return daily.groupBy("user").agg(
        F.avg("daily_events").alias("baseline_avg_events"),
        F.stddev("daily_events").alias("baseline_std_events"),
        F.max("daily_events").alias("baseline_max_events"),
        F.avg("daily_bytes_out").alias("baseline_avg_bytes_out"),
        F.stddev("daily_bytes_out").alias("baseline_std_bytes_out"),
        F.max("daily_bytes_out").alias("baseline_max_bytes_out"),
        F.avg("unique_destinations").alias("baseline_avg_destinations"),
        F.stddev("unique_destinations").alias("baseline_std_destinations"),
        F.avg("unique_hosts").alias("baseline_avg_hosts"),
        F.stddev("unique_hosts").alias("baseline_std_hosts"),
        F.avg("active_hours").alias("baseline_avg_active_hours"),
        F.avg("first_activity_hour").alias("baseline_typical_start_hour"),
        F.avg("last_activity_hour").alias("baseline_typical_end_hour"),
        # One row per day already, so a plain count is the number of distinct days.
        F.count("date").alias("baseline_active_days"),
    )


# What the narrow profile keeps of the network baseline.
NARROW_BASELINE = (
    "baseline_avg_events", "baseline_std_events",
    "baseline_avg_bytes_out", "baseline_std_bytes_out",
    "baseline_avg_destinations", "baseline_std_destinations",
    "baseline_typical_start_hour", "baseline_typical_end_hour",
    "baseline_active_days",
)


def user_baseline_narrow(daily: DataFrame) -> DataFrame:
    """The narrow profile; Spark drops the aggregates that are not selected."""
    return user_baseline_network(daily).select("user", *NARROW_BASELINE)


def user_baseline_process(daily: DataFrame) -> DataFrame:
    return daily.groupBy("user").agg(
        F.avg("daily_processes").alias("baseline_avg_processes"),
        F.stddev("daily_processes").alias("baseline_std_processes"),
        F.avg("unique_processes").alias("baseline_avg_unique_processes"),
        F.stddev("unique_processes").alias("baseline_std_unique_processes"),
        F.avg("admin_process_count").alias("baseline_avg_admin_processes"),
        F.stddev("admin_process_count").alias("baseline_std_admin_processes"),
        F.count("date").alias("baseline_process_active_days"),
    )


def rolling_baseline(
    daily: DataFrame,
    days: int = 21,
    metrics: Sequence[str] = ("daily_events", "daily_bytes_out", "unique_destinations"),
) -> DataFrame:
    """For each user-day, mean and deviation of the ``days`` days before it."""
    trailing = Window.partitionBy("user").orderBy(F.unix_date("date")).rangeBetween(-days, -1)
    columns = {}
    for metric in metrics:
        columns[f"rolling_avg_{metric}"] = F.avg(metric).over(trailing)
        columns[f"rolling_std_{metric}"] = F.stddev(metric).over(trailing)
    columns["rolling_days"] = F.count(F.lit(1)).over(trailing)
    return daily.withColumns(columns)


#: Baseline columns that a score needs, and the daily metric that each is taken from.
ROLLING = {
    "events": "daily_events", "bytes_out": "daily_bytes_out", "destinations": "unique_destinations", "hosts": "unique_hosts",
}


def rolling_as_baseline(daily: DataFrame, days: int = 21) -> DataFrame:
    """User-days with the baseline columns of the ``days`` days before each, so that they can be scored at any date.

    A user's rows are at most one per day, however many events lie behind them.
    """
    trailing = Window.partitionBy("user").orderBy(F.unix_date("date")).rangeBetween(-days, -1)
    columns = {}
    for name, metric in ROLLING.items():
        columns[f"baseline_avg_{name}"] = F.avg(metric).over(trailing)
        columns[f"baseline_std_{name}"] = F.stddev(metric).over(trailing)
    columns["baseline_typical_start_hour"] = F.avg("first_activity_hour").over(trailing)
    columns["baseline_typical_end_hour"] = F.avg("last_activity_hour").over(trailing)
    columns["baseline_active_days"] = F.count(F.lit(1)).over(trailing)
    return daily.withColumns(columns)
