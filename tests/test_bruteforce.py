"""Spark results against the same formulas written as plain loops."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from datetime import date, timedelta
from statistics import mean, stdev

import pytest

from checks import views
from veerline.config import DEFAULT, FOUR_TERM
from veerline.operators import bounds as bd, enrich, features, scores
from veerline.operators.baseline import rolling_baseline, user_baseline_network

SF_DIR = "/root/testdata/sf0.001"
BASE = ("events", "bytes_out", "destinations", "hosts")
VALUES = ("daily_events", "daily_bytes_out", "unique_destinations", "unique_hosts")


def random_days(n=600):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        row = {"user": f"u{i % 40}", "date": date(2024, 1, 1) + timedelta(days=i // 40)}
        for value, base in zip(VALUES, BASE):
            row[value] = rng.choice([None, 0, 1, rng.randint(1, 10**6)]) if value == "daily_bytes_out" else rng.randint(0, 90)
            row[f"baseline_avg_{base}"] = rng.choice([None, 0.0, rng.uniform(0, 100)])
            row[f"baseline_std_{base}"] = rng.choice([None, 0.0, rng.uniform(0.1, 40)])
        row["first_activity_hour"], row["last_activity_hour"] = sorted(rng.randint(0, 23) for _ in range(2))
        row["baseline_typical_start_hour"] = rng.choice([None, rng.uniform(5, 11)])
        row["baseline_typical_end_hour"] = rng.choice([None, rng.uniform(13, 20)])
        rows.append(row)
    return rows


def expected_score(row, profile):
    def z(value, base):
        m, s = row[f"baseline_avg_{base}"], row[f"baseline_std_{base}"]
        if s is None or s <= 0 or m is None or row[value] is None:
            return 0.0
        return abs(row[value] - m) / s

    zs = {f"{b}_zscore": z(v, b) for v, b in zip(VALUES, BASE)}
    start, end = row["baseline_typical_start_hour"], row["baseline_typical_end_hour"]
    late = (start is not None and row["first_activity_hour"] < start - 2) or (
        end is not None and row["last_activity_hour"] > end + 2
    )
    total = 0.0
    for name, weight in profile.terms:
        total += min(zs[name] / 3.0, 1.0) * weight
    return total + (1.0 if late else 0.0) * profile.after_hours


@pytest.mark.parametrize("profile", [DEFAULT.profile, FOUR_TERM])
def test_scores(spark, profile):
    rows = random_days()
    schema = ", ".join(
        ["user string", "date date"]
        + [f"{v} bigint" for v in VALUES]
        + [f"baseline_{k}_{b} double" for b in BASE for k in ("avg", "std")]
        + ["first_activity_hour int", "last_activity_hour int"]
        + ["baseline_typical_start_hour double", "baseline_typical_end_hour double"]
    )
    names = [c.split()[0] for c in schema.split(", ")]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)
    scored = scores.network_score(df, DEFAULT.with_(profile=profile)).collect()
    want = {(r["user"], r["date"]): expected_score(r, profile) for r in rows}
    for row in scored:
        score = want[(row["user"], row["date"])]
        assert row["network_anomaly_score"] == pytest.approx(score, abs=1e-12)
        level = "CRITICAL" if score >= 0.85 else "HIGH" if score >= 0.7 else "MEDIUM" if score >= 0.5 else "LOW"
        assert row["network_anomaly_level"] == level


def hot(spark):
    """Network events of which more than a third belong to one user and address."""
    return views.network(spark, SF_DIR).selectExpr(
        "* EXCEPT (user, dest_ip)",
        "CASE WHEN event_id % 5 < 2 THEN 'hot' ELSE user END AS user",
        "CASE WHEN event_id % 7 < 3 THEN '203.0.113.1' ELSE dest_ip END AS dest_ip",
    )


def test_daily_features_and_baseline_with_a_hot_user(spark):
    events = hot(spark)
    bounds = bd.resolve_bounds(events)
    rows = [r.asDict() for r in events.collect()]
    end = max(r["event_time"] for r in rows)
    groups = defaultdict(list)
    for r in rows:
        if end - timedelta(days=28) <= r["event_time"]:
            period = "baseline" if r["event_time"] < end - timedelta(days=7) else "analysis"
            groups[(r["user"], r["event_time"].date(), period)].append(r)
    daily = features.daily_network_periods(events, bounds)
    got = {(r["user"], r["date"], r["period"]): r for r in daily.collect()}
    assert set(got) == set(groups)
    for key, members in groups.items():
        row = got[key]
        hours = [m["event_time"].hour for m in members]
        assert row["daily_events"] == len(members)
        assert row["daily_bytes_out"] == sum(m["bytes_out"] for m in members)
        for name, cell in (("destinations", "dest_ip"), ("hosts", "dest_host"), ("ports", "dest_port"), ("apps", "app_name")):
            assert row[f"unique_{name}"] == len({m[cell] for m in members})
        assert (row["active_hours"], row["first_activity_hour"], row["last_activity_hour"]) == (
            len(set(hours)), min(hours), max(hours),
        )
    base = {r["user"]: r for r in user_baseline_network(features.of_period(daily, "baseline")).collect()}
    counts = [len(v) for k, v in groups.items() if k[0] == "hot" and k[2] == "baseline"]
    assert base["hot"]["baseline_avg_events"] == pytest.approx(mean(counts))
    assert base["hot"]["baseline_std_events"] == pytest.approx(stdev(counts))
    assert base["hot"]["baseline_active_days"] == len(counts)


def test_first_contacts_with_a_hot_user(spark):
    events = hot(spark)
    rows = events.select("user", "dest_ip", "event_time").collect()
    end = max(r["event_time"] for r in rows)
    cut, start = end - timedelta(days=7), end - timedelta(days=28)
    before = {(r["user"], r["dest_ip"]) for r in rows if start <= r["event_time"] < cut}
    after = {(r["user"], r["dest_ip"]) for r in rows if r["event_time"] >= cut}
    got = {(r["user"], r["dest_ip"]) for r in enrich.new_destinations(events, bd.resolve_bounds(events)).collect()}
    assert got == after - before


def test_feed_join_is_the_same_with_and_without_broadcast(spark):
    events = hot(spark)
    feed = spark.createDataFrame(
        [("203.0.113.1", "a"), ("203.0.113.1", "a"), ("10.1.0.3", "b"), (None, "c")], "dest_ip string, level string"
    )
    kept = ["event_id", "level", "threat_match"]
    small = enrich.enrich_threat_intel(events, feed, "dest_ip").select(*kept).collect()
    large = enrich.enrich_threat_intel(events, feed, "dest_ip", settings=DEFAULT.with_(broadcast_rows=1)).select(*kept)
    assert sorted(map(repr, small)) == sorted(map(repr, large.collect()))
    assert len(small) == events.count()


def test_rolling_baseline(spark):
    daily = features.daily_network(hot(spark), ("daily_events",))
    rows = rolling_baseline(daily, 5, ("daily_events",)).collect()
    counts = {(r["user"], r["date"]): r["daily_events"] for r in rows}
    for r in rows:
        earlier = [counts.get((r["user"], r["date"] - timedelta(days=d))) for d in range(1, 6)]
        earlier = [c for c in earlier if c is not None]
        assert r["rolling_days"] == len(earlier)
        assert (r["rolling_avg_daily_events"] or math.nan) == pytest.approx(mean(earlier) if earlier else math.nan, nan_ok=True)
        if len(earlier) > 1:
            assert r["rolling_std_daily_events"] == pytest.approx(stdev(earlier))
