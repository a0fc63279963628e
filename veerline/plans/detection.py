"""The statistical analysis from events to findings.

The events are read once per table: their daily features, which are smaller by the number of
events per user and day, are written to the shared folder, and everything after that is
computed from the written features.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..operators import features
from ..operators.baseline import user_baseline_network, user_baseline_process
from ..operators.bounds import Bounds, resolve_bounds
from ..operators.findings import all_findings, network_findings, process_findings
from ..operators.peers import PeerModel, peer_groups, place_users
from ..operators.risk import user_risk
from ..operators.scores import (
    PEER_PROCESS_METRICS,
    anomaly_types,
    attach_baseline,
    attach_peers,
    network_score,
    process_score,
    with_peer_deviation,
    with_peer_fallback,
)
from ..sinks.storage import materialise


@dataclass(frozen=True)
class Detection:
    bounds: Bounds
    baseline: DataFrame
    process_baseline: DataFrame | None
    peers: DataFrame
    scored_network: DataFrame
    scored_process: DataFrame | None
    risk: DataFrame
    findings: DataFrame
    peer_model: PeerModel | None = None


#: What stands in for a baseline feature while a user has only analysis days.
STAND_INS = {
    "baseline_avg_events": "daily_events", "baseline_avg_bytes_out": "daily_bytes_out",
    "baseline_avg_destinations": "unique_destinations", "baseline_avg_active_hours": "active_hours",
}


def new_users(days: DataFrame, baseline: DataFrame, model: PeerModel) -> DataFrame:
    """Peer groups of the users that have analysis days but no baseline: the nearest centroid of their daily means."""
    means = [F.avg(day).alias(name) for name, day in STAND_INS.items() if name in model.columns and day in days.columns]
    seen = days.groupBy("user").agg(*means, F.count(F.lit(1)).alias("_days"))
    return place_users(seen.join(baseline.select("user"), "user", "left_anti"), model).select("user", "peer_group")


def scored_network_days(
    events: DataFrame,
    bounds: Bounds,
    settings: Settings = DEFAULT,
    peers: DataFrame | PeerModel | Callable[[DataFrame], DataFrame | PeerModel] | None = None,
    store: bool = False,
    approx: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Network baseline, scored user-days and peer groups.

    ``peers`` are given groups, or a function of the baseline that returns groups or a ``PeerModel``. With a model and
    ``settings.peer_fallback``, users without a baseline are placed by the means of their analysis days.
    """
    # Only what scores and baselines use: every further distinct count is a further copy of
    # each event in the aggregation.
    daily = features.daily_network_periods(events, bounds, settings, features.WIDE_ANALYSIS, approx)
    if store:
        daily = materialise(daily, "daily-network")
    baseline = user_baseline_network(features.of_period(daily, "baseline"))
    if store:
        baseline = materialise(baseline, "baseline-network")
    if callable(peers):
        peers = peers(baseline)
    days = features.of_period(daily, "analysis")
    if isinstance(peers, PeerModel):
        model, peers = peers, peers.groups
        if settings.peer_fallback:
            peers = peers.unionByName(new_users(days, baseline, model))
            if store:
                peers = materialise(peers, "peers")
    if settings.peer_fallback and peers is not None:
        days = with_peer_fallback(days, baseline, peers, settings)
    else:
        days = attach_baseline(days, baseline)
        if peers is not None:
            days = attach_peers(days, peers)
    return baseline, network_score(days, settings), peers


def scored_process_days(
    events: DataFrame, bounds: Bounds, settings: Settings = DEFAULT, store: bool = False, approx: bool = False
) -> tuple[DataFrame, DataFrame]:
    daily = features.daily_process_periods(events, bounds, settings, features.PROCESS_ANALYSIS, approx)
    if store:
        daily = materialise(daily, "daily-process")
    baseline = user_baseline_process(features.of_period(daily, "baseline"))
    days = attach_baseline(features.of_period(daily, "analysis"), baseline)
    return baseline, process_score(days, settings)


def detect(
    network: DataFrame,
    process: DataFrame | None = None,
    settings: Settings = DEFAULT,
    peers: DataFrame | PeerModel | Callable[[DataFrame], DataFrame | PeerModel] | None = None,
    approx: bool = False,
) -> Detection:
    """Run the whole analysis; without ``peers`` they are found by K-means."""
    bounds = resolve_bounds(network, settings)
    model: list[PeerModel] = []

    def found(baseline: DataFrame) -> DataFrame | PeerModel:
        made = peers(baseline) if callable(peers) else peer_groups(baseline, settings)
        model.extend([made] if isinstance(made, PeerModel) else [])
        return made

    groups = found if peers is None or callable(peers) else peers
    baseline, scored, groups = scored_network_days(network, bounds, settings, groups, True, approx)
    # Stored once: risk, findings and reports all read the scored days.
    scored = materialise(scored, "scored-network")
    process_baseline = scored_process = None
    if process is not None:
        process_baseline, scored_process = scored_process_days(process, bounds, settings, True, approx)
        scored_process = materialise(scored_process, "scored-process")
    risk = materialise(user_risk(scored, scored_process, groups, settings), "risk")
    findings = network_findings(network_kinds(scored, settings), risk, bounds, settings)
    if scored_process is not None:
        kinds = process_kinds(scored_process, groups, settings)
        findings = all_findings(findings, process_findings(kinds, risk, bounds, settings))
    return Detection(
        bounds, baseline, process_baseline, groups, scored, scored_process, risk, findings, model[0] if model else None
    )


def network_kinds(scored: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Scored days with the deviation from the day's peers and the kinds of anomaly that they show."""
    return anomaly_types(with_peer_deviation(scored, settings=settings), settings)


def process_kinds(scored: DataFrame, peers: DataFrame | None, settings: Settings = DEFAULT) -> DataFrame:
    grouped = attach_peers(scored, peers) if peers is not None else scored.withColumn("peer_group", F.lit(None).cast("int"))
    return anomaly_types(with_peer_deviation(grouped, PEER_PROCESS_METRICS, settings), settings).drop("peer_group")
