"""The model run: network analysis with the four-term score, then the isolation forest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..config import DEFAULT, FOUR_TERM, Settings
from ..operators.findings import network_findings
from ..operators.model import RiskModel, ml_features, score_batch, train_model
from ..sinks.storage import materialise
from .detection import Detection, detect


@dataclass(frozen=True)
class Training:
    detection: Detection
    features: DataFrame
    model: RiskModel
    scores: DataFrame
    findings: DataFrame
    metrics: dict[str, float]


def train(
    network: DataFrame,
    settings: Settings = DEFAULT,
    peers: DataFrame | None = None,
    model_version: str = "unversioned",
    findings_limit: int | None = None,
) -> Training:
    settings = settings.with_(profile=FOUR_TERM)
    detection = detect(network, None, settings, peers)
    features = ml_features(detection.baseline, detection.peers, detection.risk)
    model = train_model(features, settings, detection.peer_model)
    # The rates are counted while the scores are written, not by jobs of their own.
    counted = Observation("training-scores")
    flagged = F.sum("is_anomaly").alias("model_anomalies")
    scored = score_batch(features, model, settings).observe(counted, F.count(F.lit(1)).alias("scored_users"), flagged)
    scores = materialise(scored, "model-scores")
    metrics = {k: v or 0 for k, v in counted.get.items()}
    metrics["model_anomaly_rate"] = metrics["model_anomalies"] / metrics["scored_users"] if metrics["scored_users"] else None
    metrics.update(contamination=model.contamination, threshold=model.threshold)
    findings = network_findings(
        detection.scored_network, detection.risk, detection.bounds, settings, findings_limit, model_version
    )
    return Training(detection, features, model, scores, findings, metrics)
