"""Findings: one explained row per anomalous user-day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..functions.text import finding_id
from ..sinks.storage import materialise
from .bounds import Bounds
from .risk import with_user_level
from .scores import anomalous

# Names and texts that consumers of the findings match on.
NETWORK_ANALYTIC = "ueba_network_anomaly_detection"
NETWORK_MODEL_ANALYTIC = "ueba_network_anomaly_detection_mlflow"
PROCESS_ANALYTIC = "ueba_process_anomaly_detection"
ANALYTIC_TYPE = "statistical_ml"
STATISTICAL_VERSION = "1.0"
MODEL_VERSION = "2.0_mlflow"
REVIEW_NETWORK = "Review detailed network logs for this user"
VERIFY_USER = "Verify user identity and location"
CHECK_EXFILTRATION = "Check for data exfiltration indicators"
KEEP_MONITORING = "Monitor ongoing activity"
PROCESS_ACTIONS = (
    "Review process execution logs",
    "Verify process hashes against threat intelligence",
    "Check for privilege escalation attempts",
)


def network_actions(settings: Settings = DEFAULT) -> Column:
    last = F.when(F.col("bytes_out_zscore") > settings.exfiltration_zscore, CHECK_EXFILTRATION).otherwise(
        KEEP_MONITORING
    )
    return F.array(F.lit(REVIEW_NETWORK), F.lit(VERIFY_USER), last)


def process_actions() -> Column:
    return F.array(*[F.lit(a) for a in PROCESS_ACTIONS])


def _midnight() -> Column:
    return F.col("date").cast("timestamp")


def _peer() -> Column:
    return F.coalesce(F.col("peer_group"), F.lit(-1)).cast("int")


def _periods(bounds: Bounds) -> list[Column]:
    return [
        F.lit(bounds.analysis_start).alias("analysis_period_start"),
        F.lit(bounds.analysis_end).alias("analysis_period_end"),
        F.lit(bounds.baseline_start).alias("baseline_period_start"),
        F.lit(bounds.analysis_start).alias("baseline_period_end"),
    ]


def network_findings(
    scored: DataFrame,
    risk: DataFrame,
    bounds: Bounds,
    settings: Settings = DEFAULT,
    limit: int | None = None,
    model_version: str | None = None,
) -> DataFrame:
    """Network findings; with ``model_version`` those of a model run, whose texts are shorter.

    The kinds of anomaly go along if the scored days have them. ``limit`` keeps the highest scores. Ids of model findings carry the name of their analytic, so that both
    kinds can be appended to one table.
    """
    rows = with_user_level(anomalous(scored, "network_anomaly_score", settings), risk)
    if limit is not None:
        rows = rows.orderBy(F.desc("network_anomaly_score"), "user", "date").limit(limit)
    day = F.col("date").cast("string")
    who = F.col("user")
    if model_version is None:
        title = F.concat(F.lit("Anomalous Network Behavior Detected - "), who)
        text = F.format_string(
            "User %s (Peer Group %d) exhibited unusual network activity on %s", who, _peer(), day
        )
        analytic = NETWORK_ANALYTIC
    else:
        title = F.concat(F.lit("Anomalous Network Behavior - "), who)
        text = F.format_string("User %s (Peer Group %d) exhibited unusual network activity", who, _peer())
        analytic = NETWORK_MODEL_ANALYTIC
    evidence = F.struct(
        F.col("daily_events").cast("bigint").alias("daily_events"),
        F.coalesce(F.col("baseline_avg_events"), F.lit(0.0)).alias("baseline_avg_events"),
        F.col("events_zscore").alias("events_zscore"),
        F.coalesce(F.col("daily_bytes_out"), F.lit(0)).cast("bigint").alias("daily_bytes_out"),
        F.col("bytes_out_zscore").alias("bytes_out_zscore"),
        F.col("unique_destinations").cast("bigint").alias("unique_destinations"),
        (F.col("after_hours_anomaly") > 0).alias("after_hours"),
    )
    columns = [
        finding_id("network_anomaly" if model_version is None else analytic).alias("finding_id"),
        _midnight().alias("event_time"),
        who,
        F.lit("network_anomaly").alias("finding_type"),
        F.col("network_anomaly_level").alias("severity"),
        title.alias("title"),
        text.alias("description"),
        F.col("network_anomaly_score").alias("risk_score"),
        F.col("final_risk_level").alias("risk_level"),
        F.lit(analytic).alias("analytic_name"),
        F.lit(ANALYTIC_TYPE).alias("analytic_type"),
        _peer().alias("peer_group"),
        network_actions(settings).alias("recommended_actions"),
        evidence.alias("network_evidence"),
        F.struct(*_periods(bounds)).alias("context"),
    ]
    columns += [F.col("anomaly_types")] if "anomaly_types" in rows.columns else []
    if model_version is not None:
        columns.append(F.lit(model_version).alias("model_version"))
    return rows.select(*columns)


def process_findings(
    scored: DataFrame, risk: DataFrame, bounds: Bounds, settings: Settings = DEFAULT
) -> DataFrame:
    rows = with_user_level(anomalous(scored, "process_anomaly_score", settings), risk)
    evidence = F.struct(
        F.col("daily_processes").cast("bigint").alias("daily_processes"),
        F.coalesce(F.col("baseline_avg_processes"), F.lit(0.0)).alias("baseline_avg_processes"),
        F.coalesce(F.col("suspicious_process_count"), F.lit(0)).cast("bigint").alias("suspicious_process_count"),
    )
    return rows.select(
        finding_id("process_anomaly").alias("finding_id"),
        _midnight().alias("event_time"),
        "user",
        F.lit("process_anomaly").alias("finding_type"),
        F.col("process_anomaly_level").alias("severity"),
        F.concat(F.lit("Anomalous Process Activity Detected - "), F.col("user")).alias("title"),
        F.format_string("User %s executed unusual processes on %s", F.col("user"), F.col("date").cast("string")).alias(
            "description"
        ),
        F.col("process_anomaly_score").alias("risk_score"),
        F.col("final_risk_level").alias("risk_level"),
        F.lit(PROCESS_ANALYTIC).alias("analytic_name"),
        F.lit(ANALYTIC_TYPE).alias("analytic_type"),
        _peer().alias("peer_group"),
        process_actions().alias("recommended_actions"),
        evidence.alias("process_evidence"),
        F.struct(*_periods(bounds)).alias("context"),
        *([F.col("anomaly_types")] if "anomaly_types" in rows.columns else []),
    )


def all_findings(network: DataFrame, process: DataFrame | None = None) -> DataFrame:
    """Both kinds in one table; what one kind lacks is NULL."""
    return network if process is None else network.unionByName(process, allowMissingColumns=True)


def with_load_meta(findings: DataFrame, version: str = STATISTICAL_VERSION, at: str | None = None) -> DataFrame:
    when = F.lit(at).cast("timestamp") if at else F.current_timestamp()
    return findings.withColumns({"load_timestamp": when, "analysis_version": F.lit(version)})


def by_severity(findings: DataFrame, levels: tuple[str, ...]) -> DataFrame:
    """Findings of these levels; rule findings write them in other letters, so case does not count."""
    return findings.filter(F.upper("severity").isin(*[x.upper() for x in levels]))


def ticket_queue(findings: DataFrame, group: str = "Security Operations") -> DataFrame:
    """Critical findings as rows for a ticket system."""
    return by_severity(findings, ("CRITICAL",)).select(
        "finding_id", "title", "description",
        F.lit("P1").alias("priority"), F.lit(group).alias("assignment_group"),
    )


def number_findings(findings: DataFrame, keys: tuple[str, ...] = ("finding_type", "event_id")) -> DataFrame:
    """Adds ``finding_id`` 1..n in the order of ``keys``, which must identify a row.

    Rows are split into ranges of keys, numbered while they are written in order, and shifted by
    the rows of the ranges before; that is the only shuffle of them. Only the row counts of the
    ranges, one per partition, are added up in one place.
    """
    ranged = (
        findings.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumns({"_range": F.spark_partition_id(), "_id": F.monotonically_increasing_id()})
    )
    # Within a partition these ids go up by one; its first one depends on its number.
    stored = materialise(ranged, "numbered")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first"))
        .select("_range", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # As many offsets as ranges, that is, at most the number of shuffle partitions.
    return (
        stored.join(F.broadcast(offsets), "_range")
        .withColumn("finding_id", F.col("_id") - F.col("_first") + 1 + F.col("_offset"))
        .drop("_range", "_id", "_first", "_offset")
    )
