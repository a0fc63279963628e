"""Small result tables; each is one or two aggregations, never a loop over rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, LEVELS, Settings
from .bounds import Bounds
from .enrich import drill_network, drill_process
from .findings import by_severity
from .risk import risk_distribution, top_users
from .scores import top_days_per_user


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def findings_by_severity(findings: DataFrame, levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """A row for every level, in the given order, also for levels without findings; case does not count."""
    counts = findings.agg(*[F.count_if(F.upper("severity") == level.upper()).alias(level) for level in levels])
    rank = F.array_position(F.array(*[F.lit(x) for x in levels]), F.col("severity"))
    return counts.unpivot([], list(levels), "severity", "findings").orderBy(rank)


def findings_by_type(findings: DataFrame) -> DataFrame:
    return findings.groupBy("finding_type", "severity").count().orderBy("finding_type", "severity")


def daily_high_risk(findings: DataFrame, levels: tuple[str, ...] = ("HIGH", "CRITICAL")) -> DataFrame:
    """Serious findings per day, latest first: how many, and of how many users."""
    return (
        by_severity(findings, levels)
        .groupBy(F.to_date("event_time").alias("date"))
        .agg(F.count(F.lit(1)).alias("findings"), F.count_distinct("user").alias("users"))
        .orderBy(F.desc("date"))
    )


def user_activity(events: DataFrame) -> DataFrame:
    return events.groupBy("user").count().orderBy(F.desc("count"), "user")


def hourly_pattern(events: DataFrame) -> DataFrame:
    return events.groupBy(F.hour("event_time").alias("hour")).count().orderBy("hour")


def labelled_summary(events: DataFrame) -> DataFrame:
    """Flagged events per user, with the set of reasons (a handful of rule names)."""
    # Counts per user and reason first, so that no event is collected.
    reasons = events.filter(F.col("is_anomaly")).groupBy("user", "anomaly_reason").count()
    return (
        reasons.groupBy("user")
        .agg(
            F.sum("count").alias("anomalous_events"),
            F.array_sort(F.collect_list("anomaly_reason")).alias("anomaly_types"),
        )
        .orderBy(F.desc("anomalous_events"), "user")
    )


def data_profile(events: DataFrame, subject: str = "dest_host", approx: bool = False) -> DataFrame:
    """One row: events, flagged events and their share, distinct users and subjects."""
    distinct = F.approx_count_distinct if approx else F.count_distinct
    return events.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("is_anomaly").alias("anomalous_events"),
        (F.count_if("is_anomaly") * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("anomalous_percent"),
        distinct("user").alias("unique_users"),
        distinct(subject).alias(f"unique_{subject}"),
    )


def row_and_user_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("user").alias("users"))


def rates(risk: DataFrame, settings: Settings = DEFAULT, scores: DataFrame | None = None) -> DataFrame:
    """One row: share of users at high risk, and with the model's ``scores`` how many users it flags, and their share."""
    high = risk.agg(F.avg((F.col("combined_risk_score") >= settings.high).cast("int")).alias("high_risk_rate"))
    if scores is None:
        return high
    flagged = scores.agg(
        F.coalesce(F.sum("is_anomaly"), F.lit(0)).alias("model_anomalies"), F.avg("is_anomaly").alias("model_anomaly_rate")
    )
    # Two tables of one row each.
    row = flagged.select(F.struct("model_anomalies", "model_anomaly_rate").alias("m")).scalar()
    return high.select("high_risk_rate", row["model_anomalies"].alias("model_anomalies"), row["model_anomaly_rate"].alias("model_anomaly_rate"))


def _section(df: DataFrame, section: str, item: str, value: str) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"),
        F.col(item).cast("string").alias("item"),
        F.col(value).cast("double").alias("value"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def analysis_summary(
    scored_network: DataFrame,
    scored_process: DataFrame | None,
    risk: DataFrame,
    findings: DataFrame,
    bounds: Bounds,
    settings: Settings = DEFAULT,
) -> DataFrame:
    """The run in one long table: section, item, value. Periods are in seconds since 1970.

    Events are counted by adding up the scored user-days; the events are not read again.
    """
    spark = risk.sparkSession
    instants = spark.range(1).select(
        *[
            F.unix_timestamp(bounds.literal(n).cast("timestamp")).alias(n)
            for n in ("baseline_start", "analysis_start", "analysis_end")
        ]
    )
    parts = [_section(instants.unpivot([], instants.columns, "item", "value"), "period", "item", "value")]
    events = [("network_events", scored_network.agg(F.sum("daily_events").alias("n")))]
    if scored_process is not None:
        events.append(("process_events", scored_process.agg(F.sum("daily_processes").alias("n"))))
    events.append(("users", risk.agg(F.count(F.lit(1)).alias("n"))))
    for name, total in events:
        parts.append(_section(total.withColumn("item", F.lit(name)), "data", "item", "n"))
    parts.append(_section(risk_distribution(risk), "risk", "final_risk_level", "count"))
    parts.append(_section(findings_by_severity(findings), "findings", "severity", "findings"))
    parts.append(_section(top_users(risk, 5, settings), "top_users", "user", "combined_risk_score"))
    return _union(parts)


def quality_summary(network: DataFrame, process: DataFrame, findings: DataFrame) -> DataFrame:
    """Profile of both event tables and of the findings, in one long table."""
    parts = []
    for name, events, subject in (("network", network, "dest_host"), ("process", process, "process_name")):
        profile = data_profile(events, subject)
        doubles = profile.select(*[F.col(c).cast("double").alias(c) for c in profile.columns])
        parts.append(_section(doubles.unpivot([], doubles.columns, "item", "value"), name, "item", "value"))
    total = row_and_user_counts(findings).select(
        F.col("rows").cast("double").alias("findings"), F.col("users").cast("double").alias("unique_users")
    )
    parts.append(_section(total.unpivot([], total.columns, "item", "value"), "findings", "item", "value"))
    by_type = findings.groupBy("finding_type").agg(F.count(F.lit(1)).alias("n"))
    parts.append(_section(by_type, "findings_by_type", "finding_type", "n"))
    return _union(parts)


def investigation(
    user: str,
    since: str,
    risk: DataFrame,
    scored: DataFrame,
    network: DataFrame,
    process: DataFrame | None = None,
    days: int = 3,
) -> dict[str, DataFrame]:
    """What an analyst looks at for one user: risk, worst days, and the events behind them."""
    views = {
        "risk": risk.filter(F.col("user") == user),
        "top_days": top_days_per_user(scored.filter(F.col("user") == user), days),
        "network": drill_network(network, user, since),
    }
    if process is not None:
        views["process"] = drill_process(process, user, since)
    return views


def investigation_summary(views: dict[str, DataFrame]) -> DataFrame:
    """One long table of an investigation: section, item (day or instant), value."""
    parts = [
        _section(views["risk"], "risk", "final_risk_level", "combined_risk_score"),
        _section(views["top_days"], "top_days", "date", "network_anomaly_score"),
        _section(
            views["network"].groupBy("dest_host").agg(F.sum("bytes_out").alias("bytes")),
            "bytes_out_by_host", "dest_host", "bytes",
        ),
    ]
    if "process" in views:
        parts.append(
            _section(views["process"].groupBy("process_name").count(), "process_runs", "process_name", "count")
        )
    return _union(parts)
