"""Operators: DataFrame in, lazy DataFrame out."""

from .baseline import rolling_baseline, user_baseline_narrow, user_baseline_network, user_baseline_process
from .bounds import Bounds, in_analysis, in_baseline, period_counts, resolve_bounds, time_bounds, with_date
from .enrich import (
    data_gaps,
    drill_network,
    drill_process,
    enrich_threat_intel,
    new_destinations,
    suppress_allowlisted,
    threat_hits,
)
from .features import (
    daily_lateral,
    daily_network,
    daily_network_periods,
    daily_process,
    daily_process_periods,
    labelled_counts,
    with_geo_features,
)
from .findings import (
    all_findings,
    by_severity,
    network_findings,
    number_findings,
    process_findings,
    ticket_queue,
    with_load_meta,
)
from .iforest import fit_iforest, score_iforest
from .model import (
    RiskModel,
    append_ledger,
    best_threshold,
    contamination,
    ensure_features,
    ensure_ids,
    evaluate,
    exact_quantile,
    flag_anomalies,
    load_model,
    ml_features,
    model_risk,
    order_statistic,
    read_ledger,
    run_metrics,
    save_model,
    score_batch,
    threshold_curve,
    train_model,
)
from .peers import (
    PeerModel,
    assemble,
    assign_peers,
    cluster_metrics,
    feature_ranges,
    minmax,
    peer_deviation,
    peer_groups,
    peer_groups_standardized,
    peer_profile,
    place_users,
    standardize,
)
from .reports import (
    analysis_summary,
    daily_high_risk,
    data_profile,
    distinct_values,
    findings_by_severity,
    findings_by_type,
    hourly_pattern,
    investigation,
    labelled_summary,
    quality_summary,
    rates,
    row_and_user_counts,
    user_activity,
)
from .risk import (
    anomaly_stats,
    combine_risk,
    combined_risk,
    high_risk_users,
    risk_distribution,
    stamp,
    top_users,
    user_network_risk,
    user_process_risk,
    user_risk,
    with_user_level,
    zero_fill,
)
from .rules import labelled, rule_findings, rule_network, rule_process, with_anomaly_reason
from .scores import (
    anomalous,
    anomaly_types,
    attach_baseline,
    attach_peers,
    network_score,
    outliers,
    process_score,
    top_days_per_user,
    top_network,
    top_process,
    with_peer_deviation,
    with_peer_fallback,
)

__all__ = [name for name in dir() if not name.startswith("_")]
