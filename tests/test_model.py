from __future__ import annotations

from dataclasses import replace

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from veerline.config import DEFAULT
from veerline.operators import iforest, model, peers as pr
from veerline.schemas import MODEL_FEATURES

SMALL = DEFAULT.with_(trees=25, tree_sample=64)


def points(spark, n=400, outliers=3):
    rng = np.random.default_rng(1)
    data = rng.normal(0, 1, (n, 2))
    data[:outliers] = [[12.0 + i, -12.0] for i in range(outliers)]
    rows = [(f"p{i:04d}", float(a), float(b)) for i, (a, b) in enumerate(data)]
    return spark.createDataFrame(rows, "user string, a double, b double")


def test_planted_outliers_rank_first(spark):
    df = points(spark)
    nodes = iforest.fit_iforest(df, ["a", "b"], SMALL)
    scored = iforest.score_iforest(df, ["a", "b"], nodes, SMALL)
    lowest = [r["user"] for r in scored.orderBy("anomaly_score").limit(3).collect()]
    assert sorted(lowest) == ["p0000", "p0001", "p0002"]
    low, high = scored.agg(F.min("anomaly_score"), F.max("anomaly_score")).first()
    assert -1.0 <= low <= high < 0.0


def test_same_seed_same_forest(spark):
    df = points(spark)
    key = ["tree", "node"]
    first = iforest.fit_iforest(df, ["a", "b"], SMALL).orderBy(*key).collect()
    again = iforest.fit_iforest(df.repartition(7), ["a", "b"], SMALL).orderBy(*key).collect()
    other = iforest.fit_iforest(df, ["a", "b"], SMALL.with_(seed=7)).orderBy(*key).collect()
    assert first == again
    assert first != other


def test_trees_use_exactly_the_sample(spark):
    nodes = iforest.fit_iforest(points(spark, 2000), ["a", "b"], SMALL)
    shape = nodes.groupBy("tree").agg(F.max("sample").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    assert len(shape) == 25
    assert {r["s"] for r in shape} == {64}
    assert max(r["n"] for r in shape) <= 2 * 64 - 1


def test_scores_match_a_walk_down_each_tree(spark):
    df = points(spark, 60)
    nodes = iforest.fit_iforest(df, ["a", "b"], SMALL)
    trees: dict[int, dict[int, object]] = {}
    for n in nodes.collect():
        trees.setdefault(n["tree"], {})[n["node"]] = n
    sample = next(iter(trees.values()))[0]["sample"]
    assert sample == 60
    usual = 2 * (math.log(sample - 1) + np.euler_gamma) - 2 * (sample - 1) / sample
    for row in iforest.score_iforest(df, ["a", "b"], nodes, SMALL).collect():
        total = 0.0
        for tree in trees.values():
            at = tree[0]
            while at["feature"] >= 0:
                at = tree[at["left"] if row[["a", "b"][at["feature"]]] <= at["threshold"] else at["right"]]
            total += at["path"]
        assert row["anomaly_score"] == pytest.approx(-(2 ** (-(total / len(trees)) / usual)))


def test_neighbouring_floats_and_constants_split(spark):
    near = float(np.nextafter(1.0, 2.0))
    rows = [(f"p{i}", 1.0 if i % 2 else near, 3.0) for i in range(40)]
    df = spark.createDataFrame(rows, "user string, a double, b double")
    nodes = iforest.fit_iforest(df, ["a", "b"], SMALL)
    scored = iforest.score_iforest(df, ["a", "b"], nodes, SMALL)
    assert scored.filter("anomaly_score is null or isnan(anomaly_score)").count() == 0
    flat = df.withColumn("a", F.lit(1.0))
    nodes = iforest.fit_iforest(flat, ["a", "b"], SMALL)
    assert nodes.filter("feature >= 0").count() == 0
    assert iforest.score_iforest(flat, ["a", "b"], nodes, SMALL).select("anomaly_score").distinct().count() == 1


def test_refuses_a_table_that_is_no_forest(spark):
    nodes = iforest.fit_iforest(points(spark), ["a", "b"], SMALL)
    with pytest.raises(ValueError):
        iforest.load_trees(nodes, SMALL.with_(trees=1, tree_sample=8))


@pytest.mark.parametrize("share", [0.0, 0.01, 0.08, 0.5, 1.0])
def test_exact_quantile(spark, share):
    values = np.concatenate([np.random.default_rng(3).normal(size=5000), np.full(2500, -0.25)])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    assert model.exact_quantile(df, "v", share) == pytest.approx(float(np.quantile(values, share)), abs=1e-12)


def test_order_statistics_of_equal_and_near_equal_values(spark):
    """Two million values, most of them equal, the others the next doubles to them: nothing to narrow by width."""
    at = F.col("id") % 1000
    up = [0.1]
    for _ in range(5):
        up.append(float(np.nextafter(up[-1], 1)))
    value = F.when(at < 990, F.lit(0.1)).otherwise(F.element_at(F.array(*map(F.lit, up)), (at % 5 + 2).cast("int")))
    values = spark.range(2_000_000).select(value.alias("v"))
    assert model.order_statistic(values, 0) == model.order_statistic(values, 1_979_999) == 0.1
    assert [model.order_statistic(values, 1_980_000 + 4000 * i) for i in range(5)] == up[1:]
    assert model.exact_quantile(values, "v", 0.05) == 0.1


def test_order_statistics_of_every_kind_of_double(spark):
    values = [-np.inf, -1e308, -2.5, -5e-324, -0.0, 0.0, 5e-324, 1e-300, 2.5, 1e308, np.inf, np.nan]
    df = spark.createDataFrame([(float(v),) for v in reversed(values)], "v double")
    assert [repr(model.order_statistic(df, i) + 0.0) for i in range(len(values))] == [repr(v + 0.0) for v in values]


def test_quantile_of_nothing(spark):
    assert model.exact_quantile(spark.createDataFrame([], "v double"), "v", 0.1) is None


def test_no_contamination_flags_nothing(spark):
    scored = spark.createDataFrame([("a", -0.9), ("b", -0.4)], "user string, anomaly_score double")
    threshold = model.threshold_at(scored, 0.0)
    assert threshold is None
    assert model.flag_anomalies(scored, threshold).agg(F.sum("is_anomaly")).first()[0] == 0


def feature_rows(spark, n=80):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        cells = [float(x) for x in rng.normal(10, 2, 8)]
        if i < 2:
            cells[2] = 500.0
        rows.append((f"u{i}", *cells, i % 3, 0.9 if i < 4 else 0.1, "HIGH" if i < 4 else "LOW"))
    names = [f"{c} double" for c in MODEL_FEATURES[:8]]
    return spark.createDataFrame(
        rows, ", ".join(["user string", *names, "peer_group int", "combined_risk_score double", "final_risk_level string"])
    )


def test_train_score_save_load(spark, tmp_path):
    features = feature_rows(spark)
    trained = model.train_model(features, SMALL)
    assert trained.contamination == pytest.approx(0.1)
    scored = model.score_batch(features, trained, SMALL)
    rows = {r["user"]: r for r in scored.collect()}
    assert rows["u0"]["is_anomaly"] == 1 and rows["u1"]["is_anomaly"] == 1
    assert sum(r["is_anomaly"] for r in rows.values()) == 8
    assert max(r["risk_score"] for r in rows.values()) == 1.0
    assert min(r["risk_score"] for r in rows.values()) == 0.0
    assert rows["u5"]["peer_group"] == 2
    model.save_model(trained, str(tmp_path / "model"))
    loaded = model.load_model(spark, str(tmp_path / "model"))
    assert loaded.columns == trained.columns and loaded.scaler == trained.scaler
    again = {r["user"]: r for r in model.score_batch(features, loaded, SMALL).collect()}
    assert again == rows


def test_a_batch_of_one_uses_the_training_range(spark):
    features = feature_rows(spark)
    trained = model.train_model(features, SMALL)
    one = model.score_batch(features.filter("user = 'u0'"), trained, SMALL).first()
    whole = model.score_batch(features, trained, SMALL).filter("user = 'u0'").first()
    # A range taken from the batch itself would give every single row 0.5.
    assert one["risk_score"] == whole["risk_score"] != 0.5


def test_rows_without_ids_and_features(spark):
    trained = model.train_model(feature_rows(spark), SMALL)
    bare = spark.createDataFrame([(150.0,)], "baseline_avg_events double")
    row = model.score_batch(bare, trained, SMALL).first()
    assert (row["user"], row["peer_group"]) == ("unknown", -1)


def test_flat_range_normalises_to_zero(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 5.0)], "user string, x double")
    ranges = pr.feature_ranges(df, ["x"]).first().asDict()
    assert [r["norm_x"] for r in pr.minmax(df, ["x"], ranges).collect()] == [0.0, 0.0]
    params = pr.scaler_stats(df, ["x"]).first().asDict()
    assert [r["std_x"] for r in pr.standardize(df, ["x"], params).collect()] == [0.0, 0.0]


def test_flat_scores_have_middle_risk(spark):
    scored = spark.createDataFrame([("a", -0.5)], "user string, anomaly_score double")
    row = model.model_risk(scored, (-0.5, -0.5)).first()
    assert (row["risk_score"], row["risk_level"]) == (0.5, "MEDIUM")


def test_kmeans_separates_clear_groups(spark):
    rows = [(f"u{i}", 10.0 if i < 10 else 1000.0, 10.0 if i < 10 else 1000.0) for i in range(20)]
    base = spark.createDataFrame(rows, "user string, baseline_avg_events double, baseline_avg_bytes_out double")
    fitted = pr.peer_groups(base, DEFAULT.with_(peer_groups=2))
    groups = {r["user"]: r["peer_group"] for r in fitted.groups.collect()}
    assert len({groups[f"u{i}"] for i in range(10)}) == 1
    assert groups["u0"] != groups["u19"]
    # Centres found by K-means assign users as the model does.
    again = pr.assign_peers(pr.normalised(base), ["norm_baseline_avg_events", "norm_baseline_avg_bytes_out"], fitted.centroids)
    assert {r["user"]: r["peer_group"] for r in again.collect()} == groups
    metrics = pr.cluster_metrics(fitted, base).first()
    assert metrics["k"] == 2 and metrics["cost"] == pytest.approx(0.0)


def test_users_are_placed_over_the_dimensions_they_have(spark):
    from veerline.operators.peers import PeerModel, peer_table, peers_from_table, place_users

    ranges = {"min_a": 0.0, "max_a": 10.0, "min_b": 0.0, "max_b": 100.0, "min_c": 1.0, "max_c": 1.0}
    found = PeerModel(None, [[0.0, 1.0, 0.0], [1.0, 0.0, 0.0], [0.4, 0.4, 0.0]], 3, 0.5, ("a", "b", "c"), ranges)
    rows = [("x", 9.0, 5.0, 1.0), ("y", None, 95.0, None), ("z", 1.0, None, None), ("none", None, None, None), ("tie", 5.0, 50.0, 1.0)]
    users = spark.createDataFrame(rows, "user string, a double, b double, c double")
    for peers in (found, peers_from_table(peer_table(found, spark))):
        placed = {r["user"]: r["peer_group"] for r in place_users(users, peers).collect()}
        assert placed == {"x": 1, "y": 0, "z": 0, "none": None, "tie": 2}
    assert {r["peer_group"] for r in place_users(users.select("user"), found).collect()} == {None}


def test_versions_of_a_model_stay_readable(spark, tmp_path):
    features = feature_rows(spark)
    trained = model.train_model(features, SMALL)
    path = str(tmp_path / "versions")
    for version, low in ((1, -5.0), (2, -6.0)):
        model.save_model(replace(trained, score_min=low), path, version)
    assert model.load_model(spark, path).score_min == -6.0
    assert model.load_model(spark, path, 1).score_min == -5.0
    # A version without a line in the manifest, as a run that broke off leaves it, is not seen.
    trained.nodes.write.parquet(f"{path}/versions/3/nodes")
    assert model.load_model(spark, path).score_min == -6.0


def test_curve_and_best_threshold(spark):
    scored = spark.createDataFrame([(f"u{i}", "2024-01-01", x) for i, x in enumerate([0.9, 0.8, 0.8, 0.4, 0.1])], "user string, date string, s double")
    labels = spark.createDataFrame([("u0", "2024-01-01", 2), ("u1", "2024-01-01", 1), ("u3", "2024-01-01", 0), ("u4", "2024-01-01", 1)], "user string, date string, known_anomalies long")
    curve = model.threshold_curve(scored, labels, "s")
    rows = [(r["threshold"], r["flagged"], r["tp"], r["fp"], r["fn"]) for r in curve.orderBy(F.desc("threshold")).collect()]
    assert rows == [(0.9, 1, 1, 0, 2), (0.8, 3, 2, 1, 1), (0.4, 4, 2, 2, 1), (0.1, 5, 3, 2, 0)]
    assert model.best_threshold(curve).first()["threshold"] == 0.1
    assert model.best_threshold(curve, 0.2).first()["threshold"] == 0.9
