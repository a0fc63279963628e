"""The daily run: read the configured tables, analyse, store the findings."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT, Settings
from ..operators.findings import (
    MODEL_VERSION,
    NETWORK_ANALYTIC,
    NETWORK_MODEL_ANALYTIC,
    PROCESS_ANALYTIC,
    STATISTICAL_VERSION,
    with_load_meta,
)
from ..operators.model import append_ledger, save_model
from ..operators.reports import analysis_summary
from ..operators.risk import stamp
from ..sinks.tables import Covered, append_to_table
from ..sources.tables import read_sources
from .detection import Detection, detect
from .training import Training, train


def covered_by(found: Detection) -> Covered:
    """What an analysis has looked at, so that it can withdraw what it no longer finds."""
    process = (PROCESS_ANALYTIC,) if found.scored_process is not None else ()
    return Covered(found.bounds, (NETWORK_ANALYTIC, *process))


def run_detection(spark: SparkSession, settings: Settings = DEFAULT) -> tuple[Detection, DataFrame]:
    """Append the findings of the configured tables; returns the analysis and its summary."""
    network, process = read_sources(spark, settings)
    found = detect(network, process, settings)
    found = replace(found, risk=stamp(found.risk))
    loaded = with_load_meta(found.findings, STATISTICAL_VERSION)
    append_to_table(loaded, settings.source_tables()["findings"], covered_by(found))
    summary = analysis_summary(
        found.scored_network, found.scored_process, found.risk, found.findings, found.bounds, settings
    )
    return found, summary


def run_training(
    spark: SparkSession, model_path: str, model_version: str, settings: Settings = DEFAULT, ledger: str | None = None
) -> Training:
    """Train and save the model, and append the findings of the run; ``ledger`` gets its parameters and metrics."""
    network, _ = read_sources(spark, settings)
    trained = train(network, settings, model_version=model_version)
    save_model(trained.model, model_path)
    if ledger:
        params = {k: getattr(settings, k) for k in ("baseline_days", "analysis_days", "peer_groups", "trees", "tree_sample", "seed")}
        peers = trained.detection.peer_model
        more = {"kmeans_cost": peers.cost, "kmeans_iterations": peers.iterations} if peers is not None else {}
        append_ledger(spark, ledger, model_version, params, {**trained.metrics, **more})
    covered = Covered(trained.detection.bounds, (NETWORK_MODEL_ANALYTIC,))
    append_to_table(with_load_meta(trained.findings, MODEL_VERSION), settings.source_tables()["findings"], covered)
    return trained
