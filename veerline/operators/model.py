"""Model-based scoring: features, contamination, threshold, risk, persistence, run metrics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..functions.scoring import ladder
from ..schemas import MODEL_FEATURES
from ..sinks.storage import materialise, publish, published
from .iforest import fit_iforest, isolation_score, load_trees, score_iforest
from .peers import PeerModel, peer_table, peers_from_table, place_users, scaler_stats, standardize
from .risk import zero_fill


def ensure_features(df: DataFrame, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Absent feature columns, and NULLs in present ones, become 0; identifiers stay."""
    present = set(df.columns)
    kept = [c for c in df.columns if c not in set(columns)]
    features = [
        (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in present else F.lit(0.0)).alias(c)
        for c in columns
    ]
    return df.select(*kept, *features)


def ensure_ids(df: DataFrame) -> DataFrame:
    """Default identifiers where a scored row came without: ``unknown`` and group -1."""
    present = set(df.columns)
    user = F.coalesce(F.col("user"), F.lit("unknown")) if "user" in present else F.lit("unknown")
    group = F.coalesce(F.col("peer_group").cast("int"), F.lit(-1)) if "peer_group" in present else F.lit(-1)
    return df.withColumns({"user": user, "peer_group": group})


def ml_features(baseline: DataFrame, peers: DataFrame, risk: DataFrame) -> DataFrame:
    """Model inputs of every user with a baseline, a peer group and a risk row."""
    joined = baseline.join(peers.select("user", "peer_group"), "user").join(
        risk.select("user", "combined_risk_score", "final_risk_level"), "user"
    )
    return zero_fill(joined).select("user", *MODEL_FEATURES, "combined_risk_score", "final_risk_level")


def contamination(risk: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One row: expected share of anomalies, twice the share of high-risk users up to a limit."""
    high = (F.col("combined_risk_score") >= settings.high).cast("int")
    return risk.agg(
        F.least(F.lit(settings.max_contamination), F.avg(high) * 2).alias("contamination")
    )


def _digits(batches: Iterator[pa.RecordBatch], prefix: int, shift: int) -> Iterator[pa.RecordBatch]:
    """How often each 16-bit digit follows ``prefix`` among the ordered bits of the doubles."""
    counts = np.zeros(1 << 16, "int64")
    for batch in batches:
        bits = _ordered(batch.column(0).to_numpy(zero_copy_only=False))
        if shift < 48:
            bits = bits[bits >> np.uint64(shift + 16) == np.uint64(prefix)]
        counts += np.bincount(((bits >> np.uint64(shift)) & np.uint64(0xFFFF)).astype("int64"), minlength=1 << 16)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[seen], pa.int64())], ["digit", "n"])


def _ordered(values: np.ndarray) -> np.ndarray:
    """Bits of doubles as unsigned numbers in the order of the doubles; -0.0 counts as 0.0, NaN comes last."""
    x = np.where(np.isnan(values), np.nan, values + 0.0).astype("float64")
    bits = x.view("int64")
    return np.where(bits < 0, ~bits, bits ^ np.int64(-(1 << 63))).view("uint64")


def _double(bits: int) -> float:
    """The double of its ordered bits."""
    raw = bits ^ (1 << 63) if bits >> 63 else ~bits & ((1 << 64) - 1)
    return float(np.array([raw], "uint64").view("float64")[0])


def order_statistic(values: DataFrame, rank: int) -> float:
    """The value of that rank (from 0) of a one-column table of doubles without NULLs.

    Radix selection: four passes, each of which counts one 16-bit digit in every task and adds up at most 65,536
    counts per task. No value is moved, and the work does not depend on how the values lie or repeat.
    """
    prefix = 0
    for shift in (48, 32, 16, 0):
        counted = values.mapInArrow(partial(_digits, prefix=prefix, shift=shift), "digit int, n long")
        # At most 65,536 rows.
        for row in counted.groupBy("digit").agg(F.sum("n").alias("n")).orderBy("digit").collect():
            if rank < row["n"]:
                prefix = prefix << 16 | row["digit"]
                break
            rank -= row["n"]
    return _double(prefix)


def exact_quantile(df: DataFrame, column: str, share: float) -> float | None:
    """Quantile with linear interpolation, exact at any number of rows; NULLs do not count.

    Two neighbouring order statistics: the second is the first again if that repeats, else the next greater value.
    Pass a stored table: it is read six times.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    rows = values.count()
    if rows == 0:
        return None
    position = share * (rows - 1)
    lower = int(position)
    first = order_statistic(values, lower)
    if position == lower:
        return first
    least = F.lit(first)
    up_to, second = values.agg(F.count_if(F.col("v") <= least), F.min(F.when(F.col("v") > least, F.col("v")))).first()
    if up_to > lower + 1 or second is None:
        second = first
    return first + (second - first) * (position - lower)


def flag_anomalies(scored: DataFrame, threshold: float | None, score: str = "anomaly_score") -> DataFrame:
    """``is_anomaly`` 1 for scores below the threshold; without a threshold nothing is flagged."""
    flag = F.lit(0) if threshold is None else (F.col(score) < F.lit(threshold)).cast("int")
    return scored.withColumn("is_anomaly", flag)


def threshold_at(scored: DataFrame, share: float, score: str = "anomaly_score") -> float | None:
    """Score below which the given share lies; ``None`` for a share of 0."""
    return exact_quantile(scored, score, share) if share and share > 0 else None


def score_range(scored: DataFrame, score: str = "anomaly_score") -> DataFrame:
    return scored.agg(F.min(score).alias("score_min"), F.max(score).alias("score_max"))


def model_risk(
    scored: DataFrame,
    limits: tuple[float, float],
    settings: Settings = DEFAULT,
    score: str = "anomaly_score",
) -> DataFrame:
    """Risk in [0,1], 1 for the lowest score of the given range, and its level.

    The range is that of the training scores; later scores outside it are cut to 0 or 1.
    """
    low, high = limits
    if high > low:
        share = F.lit(1.0) - (F.col(score) - F.lit(low)) / F.lit(high - low)
        risk = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))
    else:
        risk = F.lit(0.5)
    return scored.withColumn("risk_score", risk).withColumn("risk_level", ladder("risk_score", settings))


@dataclass(frozen=True)
class RiskModel:
    """Everything that scoring needs; the forest is a table of nodes."""

    columns: tuple[str, ...]
    scaler: dict[str, float]
    nodes: DataFrame
    contamination: float
    threshold: float | None
    score_min: float
    score_max: float
    # Centroids and ranges, so that rows without a group get that of their nearest centroid.
    peers: PeerModel | None = None


def train_model(features: DataFrame, settings: Settings = DEFAULT, peers: PeerModel | None = None) -> RiskModel:
    """Fit scaler, forest, threshold and score range on a table made by ``ml_features``."""
    columns = MODEL_FEATURES
    features = materialise(features, "model-features")
    rows = features.count()
    share = contamination(features, settings).first()["contamination"] or 0.0
    scaler = scaler_stats(features, columns).first().asDict()
    inputs = [f"std_{c}" for c in columns]
    standard = standardize(ensure_features(features, columns), columns, scaler)
    nodes = materialise(fit_iforest(standard, inputs, settings, rows), "forest")
    scored = materialise(
        score_iforest(standard, inputs, nodes, settings).select("user", "anomaly_score"), "training-scores"
    )
    low, high = score_range(scored).first()
    return RiskModel(columns, scaler, nodes, float(share), threshold_at(scored, share), low, high, peers)


def score_batch(df: DataFrame, model: RiskModel, settings: Settings = DEFAULT) -> DataFrame:
    """Score a table of feature rows, stored or streaming, without a shuffle.

    Rows without a peer group get that of the model's nearest centroid, if the model has centroids.
    """
    if model.peers is not None:
        given = F.col("peer_group").cast("int") if "peer_group" in df.columns else F.lit(None).cast("int")
        df = place_users(df.withColumn("_given", given), model.peers)
        df = df.withColumn("peer_group", F.coalesce("_given", "peer_group")).drop("_given")
    group = F.coalesce(F.col("peer_group").cast("int"), F.lit(-1)) if "peer_group" in df.columns else F.lit(-1)
    # An absent group enters the model as 0, as in training; the result shows it as -1.
    filled = ensure_ids(ensure_features(df.withColumn("_group", group), model.columns))
    ready = standardize(filled, model.columns, model.scaler)
    forest = load_trees(model.nodes, settings)
    scored = ready.withColumn("anomaly_score", isolation_score(forest, [f"std_{c}" for c in model.columns]))
    flagged = flag_anomalies(scored, model.threshold)
    return model_risk(flagged, (model.score_min, model.score_max), settings).select(
        "user", "is_anomaly", "anomaly_score", "risk_score", "risk_level", F.col("_group").alias("peer_group")
    )


def save_model(model: RiskModel, path: str, version: int | None = None) -> None:
    """Write the model as tables: ``nodes``, ``params`` and, if it has centroids, ``peers``.

    With a version they go into a folder of their own, which becomes the current model at once when all of them are
    written; earlier versions stay readable.
    """
    spark = model.nodes.sparkSession
    home = path if version is None else f"{path}/versions/{version}"
    params = [("column", str(i), name, None) for i, name in enumerate(model.columns)]
    params += [("scaler", name, None, None if v is None else float(v)) for name, v in model.scaler.items()]
    for name in ("contamination", "threshold", "score_min", "score_max"):
        value = getattr(model, name)
        params.append(("value", name, None, None if value is None else float(value)))
    params.append(("peers", "peers", None, 1.0 if model.peers is not None else 0.0))
    model.nodes.write.mode("overwrite").parquet(f"{home}/nodes")
    if model.peers is not None:
        peer_table(model.peers, spark).coalesce(1).write.mode("overwrite").parquet(f"{home}/peers")
    spark.createDataFrame(params, "kind string, name string, text string, value double").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{home}/params")
    if version is not None:
        publish(spark, path, version)


def load_model(spark: SparkSession, path: str, version: int | None = None) -> RiskModel:
    """The given version, else the one published last, else the model that lies at ``path`` itself."""
    versions = published(spark, path) if version is None else [version]
    home = f"{path}/versions/{versions[-1]}" if versions else path
    # A few dozen rows, written by save_model.
    rows = spark.read.parquet(f"{home}/params").collect()
    columns = [r["text"] for r in sorted((r for r in rows if r["kind"] == "column"), key=lambda r: int(r["name"]))]
    values = {r["name"]: r["value"] for r in rows if r["kind"] == "value"}
    scaler = {r["name"]: r["value"] for r in rows if r["kind"] == "scaler"}
    held = any(r["kind"] == "peers" and r["value"] for r in rows)
    peers = peers_from_table(spark.read.parquet(f"{home}/peers")) if held else None
    return RiskModel(tuple(columns), scaler, spark.read.parquet(f"{home}/nodes"), **values, peers=peers)


def run_metrics(spark: SparkSession, run_id: str, params: dict[str, object], metrics: DataFrame) -> DataFrame:
    """Parameters, and the columns of one row of metrics, as rows (run_id, kind, name, value)."""
    given = spark.createDataFrame(
        [(name, str(value)) for name, value in params.items()], "name string, value string"
    ).withColumn("kind", F.lit("param"))
    as_text = metrics.select(*[F.col(c).cast("string").alias(c) for c in metrics.columns])
    measured = as_text.unpivot([], as_text.columns, "name", "value").withColumn("kind", F.lit("metric"))
    return given.unionByName(measured).select(F.lit(run_id).alias("run_id"), "kind", "name", "value")


def evaluate(
    scored: DataFrame, labels: DataFrame, score: str = "network_anomaly_score", settings: Settings = DEFAULT
) -> DataFrame:
    """Detection against labelled user-days: hits, false alarms, misses, precision, recall."""
    joined = scored.select("user", "date", score).join(labels, ["user", "date"], "left")
    flagged = F.col(score) >= settings.medium
    real = F.coalesce(F.col("known_anomalies"), F.lit(0)) > 0
    counts = joined.agg(
        F.count_if(flagged & real).alias("tp"),
        F.count_if(flagged & ~real).alias("fp"),
        F.count_if(~flagged & real).alias("fn"),
    )
    return counts.select(
        "*",
        F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", F.col("tp") + F.col("fn")).alias("recall"),
    )


def threshold_curve(
    scored: DataFrame, labels: DataFrame, score: str = "network_anomaly_score", settings: Settings = DEFAULT
) -> DataFrame:
    """Detection against labelled user-days at every threshold: one row per score that occurs, flagged from it up.

    Equal scores are gathered first. The distinct ones are range-partitioned in descending order; each partition adds
    up its own rows and is shifted by the totals of those before it, one row per partition.
    """
    joined = scored.select("user", "date", F.col(score).alias("threshold")).join(labels, ["user", "date"], "left")
    real = F.coalesce(F.col("known_anomalies"), F.lit(0)) > 0
    counts = joined.groupBy("threshold").agg(F.count(F.lit(1)).alias("_n"), F.count_if(real).alias("_hits"))
    ranged = counts.repartitionByRange(F.desc("threshold")).withColumn("_range", F.spark_partition_id())
    stored = materialise(ranged, "curve")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    sums = stored.groupBy("_range").agg(F.sum("_n").alias("_ns"), F.sum("_hits").alias("_hs"))
    shifts = sums.select(
        "_range", F.coalesce(F.sum("_ns").over(before), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_hs").over(before), F.lit(0)).alias("_h0"),
        F.sum("_hs").over(whole).alias("_all"),
    )
    inside = Window.partitionBy("_range").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    # As many shifts as partitions.
    placed = stored.join(F.broadcast(shifts), "_range").select(
        "threshold", (F.sum("_hits").over(inside) + F.col("_h0")).alias("tp"), (F.sum("_n").over(inside) + F.col("_n0")).alias("flagged"), "_all"
    )
    return placed.select(
        "threshold", "flagged", "tp", (F.col("flagged") - F.col("tp")).alias("fp"), (F.col("_all") - F.col("tp")).alias("fn"),
        (F.col("tp") / F.col("flagged")).alias("precision"), F.try_divide("tp", "_all").alias("recall"),
    )


def best_threshold(curve: DataFrame, beta: float = 1.0) -> DataFrame:
    """One row: the threshold with the highest F-score; recall counts ``beta`` times as much as precision."""
    weight = beta * beta
    score = F.try_divide((1 + weight) * F.col("precision") * F.col("recall"), weight * F.col("precision") + F.col("recall"))
    return curve.withColumn("f_score", F.coalesce(score, F.lit(0.0))).orderBy(F.desc("f_score"), F.desc("threshold")).limit(1)


LEDGER = "run_id string, kind string, name string, value string"


def append_ledger(spark: SparkSession, path: str, run_id: str, params: dict[str, object], metrics: dict[str, object]) -> None:
    """Store the parameters and metrics of a run; a repeated run replaces its own rows."""
    rows = [(run_id, "param", k, None if v is None else str(v)) for k, v in params.items()]
    rows += [(run_id, "metric", k, None if v is None else str(v)) for k, v in metrics.items()]
    table = spark.createDataFrame(rows, LEDGER).coalesce(1)
    writer = table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id")
    writer.parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path)
