"""Scores of user-days: baselines attached, distances measured, terms added up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..functions.scoring import after_hours, ladder, outlier_band, sum_terms, zscore
from ..sinks.storage import broadcast_if_small

NETWORK_METRICS = {
    "events_zscore": ("daily_events", "events"),
    "bytes_out_zscore": ("daily_bytes_out", "bytes_out"),
    "destinations_zscore": ("unique_destinations", "destinations"),
    "hosts_zscore": ("unique_hosts", "hosts"),
}
PROCESS_METRICS = {
    "processes_zscore": ("daily_processes", "processes"),
    "unique_processes_zscore": ("unique_processes", "unique_processes"),
    "admin_processes_zscore": ("admin_process_count", "admin_processes"),
}


def attach_baseline(daily: DataFrame, baseline: DataFrame) -> DataFrame:
    """User-days with their user's baseline, NULL for users without one.

    Both sides are at most one row per user and day; the planner broadcasts the baseline
    only where its size allows.
    """
    return daily.join(baseline, "user", "left")


def attach_peers(users: DataFrame, peers: DataFrame) -> DataFrame:
    return users.join(peers.select("user", "peer_group"), "user", "left")


def _distances(df: DataFrame, metrics: dict[str, tuple[str, str]], settings: Settings) -> dict[str, Column]:
    present = set(df.columns)
    return {
        name: zscore(value, f"baseline_avg_{base}", f"baseline_std_{base}", settings.signed_zscore)
        for name, (value, base) in metrics.items()
        if f"baseline_std_{base}" in present
    }


def network_score(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Distances, the after-hours mark, the weighted score in [0,1] and its level."""
    profile = settings.profile
    scored = df.withColumns(
        {**_distances(df, NETWORK_METRICS, settings), "after_hours_anomaly": after_hours(settings)}
    )
    total = sum_terms(profile.terms, settings.zscore_cap) + F.col("after_hours_anomaly") * F.lit(profile.after_hours)
    return scored.withColumn("network_anomaly_score", total).withColumn(
        "network_anomaly_level", ladder("network_anomaly_score", settings)
    )


def process_score(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    scored = df.withColumns(_distances(df, PROCESS_METRICS, settings))
    tools = F.when(F.col("suspicious_process_count") > 0, 1.0).otherwise(0.0)
    total = sum_terms(settings.process_terms, settings.zscore_cap) + tools * F.lit(settings.suspicious_weight)
    return scored.withColumn("process_anomaly_score", total).withColumn(
        "process_anomaly_level", ladder("process_anomaly_score", settings)
    )


def anomalous(scored: DataFrame, score: str, settings: Settings = DEFAULT) -> DataFrame:
    return scored.filter(F.col(score) >= settings.medium)


def outliers(scored: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One row per metric of a user-day that passes the threshold, with its strength."""
    known = {**NETWORK_METRICS, **PROCESS_METRICS}
    metrics = [c for c in scored.columns if c in known]
    long = scored.unpivot(["user", "date"], metrics, "metric", "zscore")
    return long.withColumn("strength", outlier_band("zscore", settings)).filter(F.col("strength").isNotNull())


def anomaly_types(scored: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Adds ``anomaly_types``: which kinds of deviation the user-day shows."""
    present = set(scored.columns)
    limit = settings.zscore_threshold

    def over(*names: str) -> Column | None:
        conditions = [F.col(n) > limit for n in names if n in present]
        if not conditions:
            return None
        result = conditions[0]
        for condition in conditions[1:]:
            result = result | condition
        return result

    def positive(name: str) -> Column | None:
        return F.col(name) > 0 if name in present else None

    tags = {
        "volume": over("events_zscore", "bytes_out_zscore", "processes_zscore"),
        "diversity": over("destinations_zscore", "hosts_zscore", "unique_processes_zscore"),
        "temporal": positive("after_hours_anomaly"),
        "peer_deviation": over("peer_zscore"),
        "suspicious_resource": positive("suspicious_process_count"),
    }
    found = [F.when(condition, F.lit(tag)) for tag, condition in tags.items() if condition is not None]
    return scored.withColumn("anomaly_types", F.array_compact(F.array(*found)))


#: The daily metric behind each deviation from the peers of a day.
PEER_METRICS = {"peer_z_events": "daily_events", "peer_z_bytes_out": "daily_bytes_out"}
PEER_PROCESS_METRICS = {"peer_z_processes": "daily_processes", "peer_z_unique_processes": "unique_processes"}


def with_peer_deviation(
    scored: DataFrame, metrics: dict[str, str] = PEER_METRICS, settings: Settings = DEFAULT
) -> DataFrame:
    """Adds how far each user-day lies from the other members of its peer group on that day, and ``peer_zscore``.

    Mean and deviation are those of the group without the own row, worked out from the group's moments: a loud user
    does not raise the yardstick that it is measured by. Fewer than two others, no spread, no group or no value give 0.
    Moments are one row per group and day; checked to be few, they are broadcast, and the user-days stay in place.
    """
    moments = scored.groupBy("peer_group", "date").agg(
        *[f(m).alias(f"_{k}_{m}") for m in metrics.values() for k, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp))]
    ).filter(F.col("peer_group").isNotNull())
    joined = scored.join(broadcast_if_small(moments, settings), ["peer_group", "date"], "left")
    added = {}
    for name, m in metrics.items():
        x, n, mean, spread = F.col(m).cast("double"), F.col(f"_n_{m}"), F.col(f"_m_{m}"), F.col(f"_v_{m}")
        others = (n * mean - x) / F.nullif(n - 1, F.lit(0))
        rest = F.when(n > 2, F.greatest(spread * (n - 1) - (x - mean) * (x - others), F.lit(0.0)) / (n - 2))
        # What rounding leaves of no spread at all is no spread.
        std = F.when(rest > 1e-9 * F.greatest(spread, F.lit(1.0)), F.sqrt(rest))
        added[name] = F.coalesce(F.abs(x - others) / std, F.lit(0.0))
    highest = F.greatest(*[F.col(c) for c in added]) if len(added) > 1 else F.col(next(iter(added)))
    return joined.withColumns(added).withColumn("peer_zscore", highest).select(*scored.columns, *added, "peer_zscore")


def with_peer_fallback(
    daily: DataFrame, baseline: DataFrame, peers: DataFrame, settings: Settings = DEFAULT
) -> DataFrame:
    """As ``attach_baseline``, but users without a baseline take their peers' mean baseline.

    Peers may be known from elsewhere (a role list) for users without history; failing that,
    the mean over all users is taken. ``baseline_source`` says which one applies.
    """
    columns = [c for c in baseline.columns if c != "user"]
    means = [F.avg(c).alias(f"_m_{c}") for c in columns]
    by_group = baseline.join(peers.select("user", "peer_group"), "user").groupBy("peer_group").agg(
        *means, F.lit(True).alias("_has_group")
    )
    overall = baseline.agg(F.struct(*means).alias("m")).select("m").scalar()
    joined = attach_peers(attach_baseline(daily, baseline.withColumn("_own", F.lit(True))), peers)
    joined = joined.join(broadcast_if_small(by_group, settings), "peer_group", "left").withColumn("_overall", overall)
    filled = {
        c: F.when(F.col("_own"), F.col(c).cast("double"))
        .when(F.col("_has_group"), F.col(f"_m_{c}"))
        .otherwise(F.col("_overall")[f"_m_{c}"])
        for c in columns
    }
    source = F.when(F.col("_own"), "own").when(F.col("_has_group"), "peer").otherwise("global")
    return joined.withColumns({**filled, "baseline_source": source}).drop(
        "_own", "_has_group", "_overall", *[f"_m_{c}" for c in columns]
    )


def top_network(scored: DataFrame, n: int = 20, settings: Settings = DEFAULT) -> DataFrame:
    """The ``n`` highest network scores from the medium level up; user and day break ties."""
    wanted = [
        "user", "date", "peer_group", "daily_events", "baseline_avg_events", "events_zscore",
        "daily_bytes_out", "baseline_avg_bytes_out", "bytes_out_zscore",
        "network_anomaly_score", "network_anomaly_level",
    ]
    present = set(scored.columns)
    return (
        anomalous(scored, "network_anomaly_score", settings)
        .select(*[c for c in wanted if c in present])
        .orderBy(F.desc("network_anomaly_score"), "user", "date")
        .limit(n)
    )


def top_process(scored: DataFrame, n: int = 20, settings: Settings = DEFAULT) -> DataFrame:
    return (
        anomalous(scored, "process_anomaly_score", settings)
        .select(
            "user", "date", "daily_processes", "baseline_avg_processes", "processes_zscore",
            "suspicious_process_count", "process_anomaly_score", "process_anomaly_level",
        )
        .orderBy(F.desc("process_anomaly_score"), "user", "date")
        .limit(n)
    )


def top_days_per_user(scored: DataFrame, k: int = 3, score: str = "network_anomaly_score") -> DataFrame:
    """The ``k`` highest-scored days of every user."""
    order = Window.partitionBy("user").orderBy(F.desc(score), "date")
    return scored.withColumn("day_rank", F.row_number().over(order)).filter(F.col("day_rank") <= k)
