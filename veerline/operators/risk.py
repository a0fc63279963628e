"""Risk per user, from the scores of the user's days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, Settings
from ..functions.scoring import ladder
from .scores import attach_peers


def user_network_risk(scored: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Date sets are no larger than the analysis window has days."""
    score = F.col("network_anomaly_score")
    hit = score >= settings.medium
    return scored.groupBy("user").agg(
        F.max(score).alias("max_network_risk"),
        F.count_if(hit).alias("medium_high_network_days"),
        F.sum("daily_events").alias("total_events"),
        F.sum("daily_bytes_out").alias("total_bytes_out"),
        F.array_sort(F.collect_set("date")).alias("analysed_dates"),
        F.array_sort(F.collect_set(F.when(hit, F.col("date")))).alias("anomalous_dates"),
    )


def user_process_risk(scored: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    score = F.col("process_anomaly_score")
    return scored.groupBy("user").agg(
        F.max(score).alias("max_process_risk"),
        F.count_if(score >= settings.medium).alias("medium_high_process_days"),
        F.sum("suspicious_process_count").alias("total_suspicious_processes"),
    )


def zero_fill(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL to 0 in the given, or all, numeric columns."""
    return df.na.fill(0, columns) if columns else df.na.fill(0)


def combine_risk(network: DataFrame, process: DataFrame | None = None) -> DataFrame:
    """Users of either side; what one side lacks counts 0, and empty for the date sets."""
    if process is None:
        return network
    joined = zero_fill(network.join(process, "user", "full_outer"))
    empty = F.array().cast(T.ArrayType(T.DateType()))
    dates = [f.name for f in joined.schema if isinstance(f.dataType, T.ArrayType)]
    return joined.withColumns({c: F.coalesce(F.col(c), empty) for c in dates})


def combined_risk(risk: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Weighted sum of both sides, or the network side alone where no processes were analysed."""
    if "max_process_risk" in risk.columns:
        score = F.coalesce(F.col("max_network_risk"), F.lit(0.0)) * F.lit(settings.network_weight) + F.coalesce(
            F.col("max_process_risk"), F.lit(0.0)
        ) * F.lit(settings.process_weight)
    else:
        score = F.col("max_network_risk")
    return risk.withColumn("combined_risk_score", score)


def stamp(df: DataFrame, at: str | None = None) -> DataFrame:
    """Adds the time of the analysis: now, or a given instant for reproducible output."""
    when = F.lit(at).cast("timestamp") if at else F.current_timestamp()
    return df.withColumn("analysis_timestamp", when)


def user_risk(
    scored_network: DataFrame,
    scored_process: DataFrame | None = None,
    peers: DataFrame | None = None,
    settings: Settings = DEFAULT,
) -> DataFrame:
    """User risk table: both sides combined, peer group attached, level assigned."""
    network = user_network_risk(scored_network, settings)
    process = user_process_risk(scored_process, settings) if scored_process is not None else None
    risk = combined_risk(combine_risk(network, process), settings)
    if peers is not None:
        risk = attach_peers(risk, peers)
    return risk.withColumn("final_risk_level", ladder("combined_risk_score", settings))


def high_risk_users(risk: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    return risk.filter(F.col("combined_risk_score") >= settings.high).orderBy(
        F.desc("combined_risk_score"), "user"
    )


def top_users(risk: DataFrame, n: int = 5, settings: Settings = DEFAULT) -> DataFrame:
    return high_risk_users(risk, settings).select("user", "combined_risk_score", "final_risk_level").limit(n)


def with_user_level(scored: DataFrame, risk: DataFrame) -> DataFrame:
    """Scored user-days with the peer group and level of the user's risk row."""
    group = F.col("peer_group") if "peer_group" in risk.columns else F.lit(None).cast("int").alias("peer_group")
    levels = risk.select("user", group, "final_risk_level")
    return scored.drop("peer_group").join(levels, "user")


def anomaly_stats(scored: DataFrame, score: str = "network_anomaly_score", settings: Settings = DEFAULT) -> DataFrame:
    """One row, one pass: anomalous, critical and high user-days."""
    value = F.col(score)
    return scored.agg(
        F.count_if(value >= settings.medium).alias("total_anomalies"),
        F.count_if(value >= settings.critical).alias("critical_anomalies"),
        F.count_if((value >= settings.high) & (value < settings.critical)).alias("high_anomalies"),
    )


def risk_distribution(risk: DataFrame) -> DataFrame:
    return risk.groupBy("final_risk_level").count().orderBy(F.desc("count"), "final_risk_level")
