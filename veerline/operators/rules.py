"""Rule findings: one row per flagged event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from .findings import number_findings


def labelled(events: DataFrame) -> DataFrame:
    return events.filter(F.col("is_anomaly"))


def with_anomaly_reason(events: DataFrame, hours: tuple[int, int], settings: Settings = DEFAULT) -> DataFrame:
    """Why an event stands out: a large flagged transfer, else a time outside ``hours``."""
    hour = F.hour("event_time")
    reason = F.when(
        F.col("is_anomaly") & (F.col("bytes_out") > settings.exfiltration_bytes), "data_exfiltration"
    ).when((hour < hours[0]) | (hour > hours[1]), "after_hours")
    return events.withColumn("anomaly_reason", reason)


def rule_severity(family: str) -> tuple[Column, Column]:
    """Severity and score of a rule finding."""
    if family == "process_anomaly":
        return F.lit("High"), F.lit(0.9)
    exfiltration = F.col("anomaly_reason") == "data_exfiltration"
    return F.when(exfiltration, "High").otherwise("Medium"), F.when(exfiltration, 0.8).otherwise(0.6)


def rule_network(events: DataFrame) -> DataFrame:
    severity, score = rule_severity("network_anomaly")
    # Fixed value: an event without a reason is reported under the word "None".
    reason = F.coalesce(F.col("anomaly_reason"), F.lit("None"))
    return labelled(events).select(
        "event_id", "event_time", "user",
        F.lit("network_anomaly").alias("finding_type"),
        severity.alias("severity"),
        F.concat(F.lit("Anomalous Network Activity Detected - "), reason).alias("title"),
        F.format_string("User %s exhibited unusual network behavior", F.col("user")).alias("description"),
        "src_ip", "dest_ip", "dest_host",
        F.col("bytes_out").alias("bytes_transferred"),
        F.concat(F.lit("rule_network_"), reason).alias("analytic_name"),
        score.alias("risk_score"),
        F.lit("Alert Generated").alias("action_taken"),
    )


def rule_process(events: DataFrame) -> DataFrame:
    severity, score = rule_severity("process_anomaly")
    return labelled(events).select(
        "event_id", "event_time", "user",
        F.lit("process_anomaly").alias("finding_type"),
        severity.alias("severity"),
        F.lit("Suspicious Process Execution Detected").alias("title"),
        F.format_string(
            "User %s executed suspicious process: %s", F.col("user"), F.col("process_name")
        ).alias("description"),
        "host", "process_name", "cmd_line",
        F.col("sha256_hash").alias("process_hash"),
        F.lit("rule_suspicious_process").alias("analytic_name"),
        score.alias("risk_score"),
        F.lit("Alert Generated").alias("action_taken"),
    )


def rule_findings(network: DataFrame, process: DataFrame | None = None) -> DataFrame:
    """All rule findings, numbered from 1, network before process, in order of the events."""
    rows = rule_network(network)
    if process is not None:
        rows = rows.unionByName(rule_process(process), allowMissingColumns=True)
    return number_findings(rows).drop("event_id")
