"""Edge cases of windows, features and scores on hand-made rows."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veerline.config import DEFAULT, FOUR_TERM
from veerline.functions import ladder, sum_terms, zscore
from veerline.operators import baseline, bounds as bd, enrich, features, reports, risk as rk, scores
from veerline.operators.bounds import resolve_bounds
from veerline.plans import detect
from veerline.plans.detection import scored_network_days

from .rows import END, frame, network_row, process_row, processes, steady


def scored_days(spark, rows, settings=DEFAULT, peers=None):
    events = frame(spark, rows)
    _, scored, _ = scored_network_days(events, resolve_bounds(events, settings), settings, peers)
    return {(r["user"], str(r["date"])): r for r in scored.collect()}


def test_window_edges(spark):
    rows = [
        network_row(END - timedelta(days=28, microseconds=1), "early"),
        network_row(END - timedelta(days=28), "first"),
        network_row(END - timedelta(days=7, microseconds=1), "last_baseline"),
        network_row(END - timedelta(days=7), "first_analysis"),
        network_row(END, "last"),
    ]
    events = frame(spark, rows)
    bounds = resolve_bounds(events)
    users = lambda df: {r["user"] for r in df.collect()}
    assert users(bd.in_baseline(events, bounds)) == {"first", "last_baseline"}
    assert users(bd.in_analysis(events, bounds)) == {"first_analysis", "last"}
    counts = bd.period_counts(events, bounds).first()
    assert (counts["baseline_events"], counts["analysis_events"]) == (2, 2)


def test_split_day_gives_a_row_in_each_period(spark):
    cut = END - timedelta(days=7)
    events = frame(
        spark,
        [network_row(cut - timedelta(hours=1)), network_row(cut + timedelta(hours=1)), network_row(END, "other")],
    )
    daily = features.daily_network_periods(events, resolve_bounds(events)).filter("user = 'ann'").collect()
    assert sorted((r["period"], r["daily_events"]) for r in daily) == [("analysis", 1), ("baseline", 1)]
    assert len({r["date"] for r in daily}) == 1


def test_aligned_bounds_do_not_split_a_day(spark):
    events = frame(spark, [network_row(END)])
    bounds = resolve_bounds(events, DEFAULT.with_(align_to_day=True))
    assert bounds.analysis_start == "2024-03-24 00:00:00"
    assert bounds.baseline_start == "2024-03-03 00:00:00"


def test_no_events_is_an_error(spark):
    with pytest.raises(ValueError):
        resolve_bounds(frame(spark, [network_row(END)]).filter("false"))


def test_partition_column_limits_the_search_and_the_scan(spark, tmp_path):
    from veerline.sinks import write_events

    rows = steady("ann", 20, 2) + [network_row(END)]
    path = str(tmp_path / "events")
    write_events(frame(spark, rows), path)
    stored = spark.read.parquet(path)
    settings = DEFAULT.with_(partition_column="date")
    bounds = resolve_bounds(stored, settings)
    assert bounds == resolve_bounds(frame(spark, rows))
    plan = bd.in_analysis(stored, bounds, settings)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in text and "PushedFilters: [IsNotNull(event_time)" in text
    assert plan.count() == bd.in_analysis(frame(spark, rows), bounds).count()


def test_one_baseline_day_scores_zero(spark):
    rows = steady("ann", 1, 3) + [network_row(END - timedelta(minutes=m)) for m in range(40)]
    day = scored_days(spark, rows)[("ann", "2024-03-31")]
    assert day["baseline_std_events"] is None
    assert day["events_zscore"] == 0.0


def test_constant_user_scores_zero(spark):
    rows = steady("ann", 15, 3) + [network_row(END - timedelta(minutes=m)) for m in range(40)]
    day = scored_days(spark, rows)[("ann", "2024-03-31")]
    assert day["baseline_std_events"] == 0.0
    assert day["events_zscore"] == 0.0


def test_unknown_user_scores_zero(spark):
    rows = steady("bob", 15, lambda i: 2 + i % 3) + [network_row(END, "new")]
    day = scored_days(spark, rows)[("new", "2024-03-31")]
    assert day["network_anomaly_score"] == 0.0
    assert day["network_anomaly_level"] == "LOW"


def test_unknown_user_takes_the_peers_baseline(spark):
    rows = steady("bob", 15, lambda i: 2 + i % 3)
    rows += [network_row(END - timedelta(minutes=m), "new") for m in range(60)]
    roles = spark.createDataFrame([("bob", 0), ("new", 0)], "user string, peer_group int")
    day = scored_days(spark, rows, DEFAULT.with_(peer_fallback=True), roles)[("new", "2024-03-31")]
    assert day["baseline_source"] == "peer"
    assert day["baseline_avg_events"] == pytest.approx(3.0)
    assert day["events_zscore"] > 10
    nobody = spark.createDataFrame([("bob", 0)], "user string, peer_group int")
    day = scored_days(spark, rows, DEFAULT.with_(peer_fallback=True), nobody)[("new", "2024-03-31")]
    assert day["baseline_source"] == "global"
    assert day["baseline_avg_events"] == pytest.approx(3.0)


def test_missing_bytes_count_zero_not_one(spark):
    rows = steady("ann", 15, lambda i: 2 + i % 3) + [network_row(END, bytes_out=None)]
    day = scored_days(spark, rows)[("ann", "2024-03-31")]
    assert day["daily_bytes_out"] is None
    assert day["baseline_std_bytes_out"] > 0
    assert day["bytes_out_zscore"] == 0.0


def test_drop_in_volume_counts_unless_signed(spark):
    rows = steady("ann", 15, lambda i: 50 + i % 3) + [network_row(END)]
    key = ("ann", "2024-03-31")
    assert scored_days(spark, rows)[key]["events_zscore"] > 3
    assert scored_days(spark, rows, DEFAULT.with_(signed_zscore=True))[key]["events_zscore"] < -3


def test_after_hours_margin(spark):
    rows = steady("ann", 15, 2)
    late = network_row(END.replace(hour=12) - timedelta(days=1))
    later = network_row(END.replace(hour=13) - timedelta(days=2))
    days = scored_days(spark, rows + [late, later, network_row(END, "other")])
    assert days[("ann", "2024-03-30")]["after_hours_anomaly"] == 0.0
    assert days[("ann", "2024-03-29")]["after_hours_anomaly"] == 1.0


def test_threshold_tie_is_high(spark):
    row = spark.createDataFrame([(9.0, 9.0, 0.0, 9.0)], "events_zscore double, bytes_out_zscore double,"
                                " destinations_zscore double, hosts_zscore double")
    total = sum_terms(DEFAULT.profile.terms, DEFAULT.zscore_cap)
    got = row.select(total.alias("s"), ladder(total).alias("level")).first()
    assert got["s"] == 0.2 + 0.4 + 0.0 + 0.1
    assert got["level"] == "HIGH"


@pytest.mark.parametrize("profile,best", [(DEFAULT.profile, 1.0), (FOUR_TERM, 1.0)])
def test_weights_add_up_to_one(profile, best):
    assert sum(w for _, w in profile.terms) + profile.after_hours == pytest.approx(best)


def test_scores_stay_between_zero_and_one(spark):
    rows = steady("ann", 20, lambda i: 1 + i % 4) + steady("bob", 20, lambda i: 5 + i % 7)
    rows += [network_row(END - timedelta(hours=h), "ann", bytes_out=10**9) for h in range(150)]
    for day in scored_days(spark, rows).values():
        assert 0.0 <= day["network_anomaly_score"] <= 1.0


def test_zscore_of_null_std(spark):
    row = spark.createDataFrame([(5.0, 1.0, None)], "v double, m double, s double")
    assert row.select(zscore("v", "m", "s")).first()[0] == 0.0


def test_suspicious_by_name_or_label(spark):
    events = processes(
        spark,
        [
            process_row(END, process_name="mimikatz.exe"),
            process_row(END, process_name="cmd.exe", is_anomaly=True),
            process_row(END, process_name="excel.exe", is_anomaly=True),
        ],
    )
    names = features.daily_process(events).first()
    assert (names["suspicious_process_count"], names["admin_process_count"]) == (1, 1)
    label = features.daily_process(events, DEFAULT.with_(suspicious_by="label")).first()
    assert label["suspicious_process_count"] == 2


def test_approximate_counts_are_close(spark):
    rows = [network_row(END, dest_ip=f"203.0.{i // 250}.{i % 250}") for i in range(2000)]
    events = frame(spark, rows)
    exact = features.daily_network(events).first()["unique_destinations"]
    near = features.daily_network(events, approx=True).first()["unique_destinations"]
    assert exact == 2000
    assert abs(near - exact) < 0.15 * exact


def test_one_sided_users(spark):
    network = frame(spark, steady("net", 15, lambda i: 2 + i % 3) + [network_row(END, "net")])
    process = processes(
        spark,
        [process_row(END - timedelta(days=d, hours=1), "proc", process_name="mimikatz.exe") for d in (1, 10, 11)],
    )
    nobody = spark.createDataFrame([], "user string, peer_group int")
    risk = {r["user"]: r for r in detect(network, process, peers=nobody).risk.collect()}
    assert risk["proc"]["combined_risk_score"] == pytest.approx(0.4 * 0.2)
    assert risk["proc"]["analysed_dates"] == [] and risk["proc"]["anomalous_dates"] == []
    assert risk["proc"]["total_events"] == 0
    assert risk["net"]["combined_risk_score"] == pytest.approx(0.6 * risk["net"]["max_network_risk"])


def test_without_processes_the_network_decides(spark):
    rows = steady("ann", 15, lambda i: 2 + i % 3)
    rows += [network_row(END - timedelta(minutes=m), bytes_out=10**6, dest_ip=f"203.0.113.{m}") for m in range(60)]
    nobody = spark.createDataFrame([], "user string, peer_group int")
    found = detect(frame(spark, rows), None, peers=nobody)
    row = found.risk.first()
    assert row["combined_risk_score"] == row["max_network_risk"] > 0.7
    assert row["final_risk_level"] == "HIGH"
    assert found.scored_process is None
    assert {r["finding_type"] for r in found.findings.collect()} == {"network_anomaly"}


def test_distribution_counts_every_user(spark):
    risk = spark.createDataFrame([("a", "LOW"), ("b", "LOW"), ("c", "HIGH")], "user string, final_risk_level string")
    rows = rk.risk_distribution(risk).collect()
    assert [(r["final_risk_level"], r["count"]) for r in rows] == [("LOW", 2), ("HIGH", 1)]


def test_severity_report_shows_empty_levels(spark):
    findings = spark.createDataFrame([("HIGH",)], "severity string")
    rows = [(r["severity"], r["findings"]) for r in reports.findings_by_severity(findings).collect()]
    assert rows == [("CRITICAL", 0), ("HIGH", 1), ("MEDIUM", 0), ("LOW", 0)]


def test_top_k_breaks_ties_by_user_and_day(spark):
    scored = spark.createDataFrame(
        [("b", "2024-01-01", 0.9), ("a", "2024-01-02", 0.9), ("a", "2024-01-01", 0.9), ("c", "2024-01-01", 0.4)],
        "user string, date string, network_anomaly_score double",
    ).withColumn("date", F.to_date("date"))
    rows = scores.top_network(scored, 2).collect()
    assert [(r["user"], str(r["date"])) for r in rows] == [("a", "2024-01-01"), ("a", "2024-01-02")]


def test_rolling_baseline_excludes_the_day_itself(spark):
    daily = features.daily_network(frame(spark, steady("ann", 4, lambda i: i + 1)))
    rows = baseline.rolling_baseline(daily, 2, ("daily_events",)).orderBy("date").collect()
    assert [r["rolling_avg_daily_events"] for r in rows] == [None, 1.0, 1.5, 2.5]


def test_sketches_change_scores_little(spark):
    rows = steady("ann", 20, lambda i: 3 + i % 4) + steady("bob", 20, lambda i: 5 + i % 7)
    rows += [network_row(END - timedelta(minutes=m), "ann", dest_ip=f"203.0.113.{m}") for m in range(90)]
    nobody = spark.createDataFrame([], "user string, peer_group int")
    events = frame(spark, rows)
    exact = {(r["user"], r["date"]): r for r in detect(events, None, peers=nobody).scored_network.collect()}
    near = detect(events, None, peers=nobody, approx=True).scored_network.collect()
    assert len(near) == len(exact)
    for row in near:
        assert row["daily_events"] == exact[(row["user"], row["date"])]["daily_events"]
        score = exact[(row["user"], row["date"])]["network_anomaly_score"]
        assert row["network_anomaly_score"] == pytest.approx(score, abs=0.1)


def test_the_own_day_does_not_raise_the_yardstick(spark):
    import numpy as np

    from veerline.operators.scores import with_peer_deviation

    day = {0: [5, 7, 6, 60], 1: [3, 3, 3], 2: [4, 9]}
    rows = [(f"g{g}-{i}", "2024-03-01", g, x, None if i == 0 else x * 10) for g, xs in day.items() for i, x in enumerate(xs)]
    rows.append(("none", "2024-03-01", None, 9, 9))
    scored = spark.createDataFrame(rows, "user string, date string, peer_group int, daily_events long, daily_bytes_out long")
    found = {r["user"]: r for r in with_peer_deviation(scored).collect()}
    for i, x in enumerate(day[0]):
        others = [v for j, v in enumerate(day[0]) if j != i]
        assert found[f"g0-{i}"]["peer_z_events"] == pytest.approx(abs(x - np.mean(others)) / np.std(others, ddof=1))
    assert found["g0-3"]["peer_zscore"] > 50
    # No spread, fewer than two others, no group, no value.
    assert {found[u]["peer_zscore"] for u in ("g1-0", "g2-0", "g2-1", "none")} == {0.0}
    assert found["g0-0"]["peer_z_bytes_out"] == 0.0


def test_one_feed_of_addresses_domains_and_hashes(spark):
    from veerline.operators.enrich import enrich_threat_any

    rows = [
        (1, "1.1.1.1", "A.B.Evil.example", None), (2, None, "evil.example.", "FF"), (3, "2.2.2.2", "notevil.example", "aa"),
        (4, None, None, None), (5, "1.1.1.1", "example", "ff"),
    ]
    events = spark.createDataFrame(rows, "event_id long, dest_ip string, dest_host string, sha256_hash string")
    feed = spark.createDataFrame(
        [("ip", "1.1.1.1"), ("ip", "1.1.1.1"), ("domain", "EVIL.example"), ("hash", "ff"), ("hash", None), ("ip", "aa")], "kind string, value string"
    )
    keys = {"ip": ("dest_ip",), "domain": ("dest_host",), "hash": ("sha256_hash",)}
    for rows_ in (200_000, 1):
        found = enrich_threat_any(events, feed, keys, settings=DEFAULT.with_(broadcast_rows=rows_)).collect()
        assert {r["event_id"]: (r["threat_match"], r["threat_kinds"]) for r in found} == {
            1: (True, ["domain", "ip"]), 2: (True, ["domain", "hash"]), 3: (False, []), 4: (False, []), 5: (True, ["hash", "ip"]),
        }


def test_gaps_of_a_period_longer_than_one_number_of_bits(spark):
    bounds = bd.Bounds("2024-01-01 06:00:00", "2024-05-01 00:00:00", "2024-05-10 12:00:00", T.TimestampNTZType())
    all_days = [datetime(2024, 1, 1, 12) + timedelta(days=i) for i in range(131)]
    seen = {"every": set(range(131)), "ends": {0, 59, 60, 119, 120, 130}, "once": {64}}
    rows = [(user, all_days[i]) for user, days in seen.items() for i in days for _ in range(2)]
    events = spark.createDataFrame(rows + [("before", datetime(2024, 1, 1, 5))], "user string, event_time timestamp_ntz")
    got = {tuple(r) for r in enrich.data_gaps(events, bounds).collect()}
    assert got == {(user, all_days[i].date()) for user, days in seen.items() for i in range(131) if i not in days}


def test_reports_take_severities_in_any_case(spark):
    findings = spark.createDataFrame(
        [("High", "a", datetime(2024, 1, 1)), ("HIGH", "b", datetime(2024, 1, 1)), ("low", "c", datetime(2024, 1, 1))],
        "severity string, user string, event_time timestamp_ntz",
    )
    assert {r["severity"]: r["findings"] for r in reports.findings_by_severity(findings).collect()} == {
        "CRITICAL": 0, "HIGH": 2, "MEDIUM": 0, "LOW": 1,
    }
    assert [(r["findings"], r["users"]) for r in reports.daily_high_risk(findings).collect()] == [(2, 2)]


def test_reasons_without_a_name_still_count(spark):
    events = spark.createDataFrame(
        [("a", True, "x"), ("a", True, None), ("a", True, "x"), ("a", False, "y"), ("b", True, None)],
        "user string, is_anomaly boolean, anomaly_reason string",
    )
    rows = [tuple(r) for r in reports.labelled_summary(events).collect()]
    assert rows == [("a", 3, ["x"]), ("b", 1, [])]
