"""One query per operator of the inventory, over the whole test tables."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veerline import schemas, sinks, sources
from veerline.config import FOUR_TERM
from veerline.functions import (
    baseline_ratio,
    capped,
    is_admin_process,
    is_suspicious_process,
    ladder,
    parse_ocsf_ts,
)
from veerline.operators import (
    baseline,
    bounds as bd,
    enrich,
    features,
    findings as fd,
    iforest,
    model,
    peers as pr,
    reports,
    risk as rk,
    rules,
    scores,
)
from veerline.plans import (
    baseline_of_days,
    covered_by,
    detect,
    refresh_days,
    rolling_scores,
    stored_days,
    train,
)
from veerline.plans.detection import network_kinds, process_kinds
from veerline.streaming import (
    ROCKSDB,
    alert_stream,
    current_alerts,
    read_event_stream,
    revised_daily,
    score_stream,
    stream_daily,
)

from . import views
from .prelude import PRELUDE
from .registry import check
from .views import CENTROIDS, HOURS, SETTINGS, network, process, table

NORMS = ["norm_baseline_avg_events", "norm_baseline_avg_bytes_out"]
USER, SINCE = "u5", "2024-01-20"

# --- building blocks ---------------------------------------------------------------------


def _bounds(spark: SparkSession, sf: str):
    return bd.resolve_bounds(network(spark, sf), SETTINGS)


def _reasoned(spark, sf):
    return rules.with_anomaly_reason(network(spark, sf), HOURS, SETTINGS)


def _baseline(spark, sf, bounds=None):
    events = bd.in_baseline(network(spark, sf), bounds or _bounds(spark, sf), SETTINGS)
    return baseline.user_baseline_network(features.daily_network(events))


def _analysis(spark, sf, bounds=None):
    events = bd.in_analysis(network(spark, sf), bounds or _bounds(spark, sf), SETTINGS)
    return features.daily_network(events, features.WIDE_ANALYSIS)


def _process_baseline(spark, sf, bounds=None):
    events = bd.in_baseline(process(spark, sf), bounds or _bounds(spark, sf), SETTINGS)
    return baseline.user_baseline_process(features.daily_process(events, SETTINGS))


def _process_analysis(spark, sf, bounds=None):
    events = bd.in_analysis(process(spark, sf), bounds or _bounds(spark, sf), SETTINGS)
    return features.daily_process(events, SETTINGS, features.PROCESS_ANALYSIS)


def _assigned(base: DataFrame) -> DataFrame:
    """Peer groups by fixed centres: K-means numbers its groups arbitrarily."""
    return pr.assign_peers(pr.normalised(base), NORMS, CENTROIDS)


def _peers_of(base: DataFrame) -> DataFrame:
    return _assigned(base).select("user", "peer_group")


def _scored(spark, sf, settings=SETTINGS):
    bounds = _bounds(spark, sf)
    base = sinks.materialise(_baseline(spark, sf, bounds), "baseline")
    days = scores.attach_baseline(_analysis(spark, sf, bounds), base)
    return scores.network_score(scores.attach_peers(days, _peers_of(base)), settings)


def _process_scored(spark, sf):
    bounds = _bounds(spark, sf)
    days = scores.attach_baseline(_process_analysis(spark, sf, bounds), _process_baseline(spark, sf, bounds))
    return scores.process_score(days, SETTINGS)


def _detect(spark, sf):
    return detect(network(spark, sf), process(spark, sf), SETTINGS, _peers_of)


def _train(spark, sf):
    return train(network(spark, sf), SETTINGS, model_version="run-1")


def _features(spark, sf):
    d = _detect(spark, sf)
    return model.ml_features(d.baseline, d.peers, d.risk)


def _vectors(spark, sf):
    """Scores that both engines have: the first component of every embedding."""
    return table(spark, sf, "embeddings").select(
        "vec_id", F.element_at("embedding", 1).cast("double").alias("anomaly_score")
    )


def _scratch(spark, label):
    return f"{sinks.scratch_dir(spark)}/veerline/{label}-{uuid.uuid4().hex}"


FINDING_COLUMNS = (
    "finding_id event_time user finding_type severity title description risk_score risk_level"
    " analytic_name analytic_type peer_group recommended_actions"
).split()
NET_FLAT = (
    'event_time, "user", src_ip, src_port, dest_ip, dest_host, dest_port, protocol, app_name,'
    " bytes_in, bytes_out, packets_in, packets_out, session_duration, action"
)
NET_COLUMNS = [c.strip().strip('"') for c in NET_FLAT.split(",")]
PROC_FLAT = (
    'event_time, "user", host, process_name, process_path, cmd_line, parent_process, md5_hash, sha256_hash'
)
PROC_COLUMNS = [c.strip().strip('"') for c in PROC_FLAT.split(",")]
WIDE_SQL = ", ".join(features.WIDE)
PROCESS_SQL = ", ".join(features.PROCESS)

# --- A: sources --------------------------------------------------------------------------


@check("a1_read_events", "SELECT event_id, ts, user_id, event_type, value, props FROM events", "value", times="ts")
def _(spark, sf):
    return sources.read_events(spark, f"{sf}/events.parquet")


@check("a2_read_optional", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(spark, sf):
    present = sources.read_optional(spark, f"{sf}/events.parquet")
    absent = sources.read_optional(spark, f"{sf}/no_such_table.parquet")
    return (present if absent is None else absent).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@check(
    "a4_read_ocsf_csv",
    f"SELECT {NET_FLAT.replace('event_time,', 'event_time_ms,')} FROM"
    " (SELECT *, date_trunc('millisecond', event_time) AS event_time_ms FROM net) n",
    times="event_time_ms",
)
def _(spark, sf):
    path = _scratch(spark, "csv")
    # The feed writes milliseconds and pretty-printed JSON over several lines.
    feed = views.ocsf_network(spark, sf)
    feed = feed.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS") for c in ("EVENT_TIME", "START_TIME", "END_TIME")}
    ).withColumns({c: F.replace(c, F.lit(","), F.lit(",\n  ")) for c in ("TRAFFIC", "SRC_ENDPOINT", "DST_ENDPOINT")})
    feed.write.option("header", True).option("escape", '"').csv(path)
    flat = sources.flatten_network(sources.read_ocsf_csv(spark, path, schemas.OCSF_NETWORK))
    return flat.select(*NET_COLUMNS).withColumnRenamed("event_time", "event_time_ms")


@check("a5_flatten_network", f"SELECT {NET_FLAT} FROM net", times="event_time")
def _(spark, sf):
    return sources.flatten_network(views.ocsf_network(spark, sf)).select(*NET_COLUMNS)


@check("a6_flatten_process", f"SELECT {PROC_FLAT} FROM procx", times="event_time")
def _(spark, sf):
    return sources.flatten_process(views.ocsf_process(spark, sf)).select(*PROC_COLUMNS)


@check(
    "a7_flatten_finding",
    """
    SELECT event_time, CAST(event_id AS VARCHAR) AS finding_uid,
           'transfer ' || CAST(event_id AS VARCHAR) AS title, 'large_transfer' AS analytic_name,
           'rule' AS analytic_type, 'url' AS finding_types, date_trunc('second', event_time) AS first_seen_time,
           src_ip, "user" AS src_owner, dest_ip, dest_host, dest_port, protocol, dest_host || '/' AS url,
           'Informational' AS severity, 'Allowed' AS action
    FROM net WHERE is_anomaly
    """,
    times="event_time first_seen_time",
)
def _(spark, sf):
    return sources.flatten_finding(views.ocsf_finding(spark, sf)).drop("risk_level", "risk_score")


@check(
    "a8_parse_ocsf_ts",
    """
    SELECT event_id, date_trunc('millisecond', ts) AS offset_time, date_trunc('millisecond', ts) AS zulu_time,
           date_trunc('millisecond', ts) AS naive_time FROM events
    """,
    times="offset_time zulu_time naive_time",
)
def _(spark, sf):
    ts = F.col("ts").cast("timestamp")
    text = "yyyy-MM-dd HH:mm:ss.SSS"
    cells = table(spark, sf, "events").select(
        "event_id",
        F.concat(F.date_format(ts - F.make_dt_interval(hours=F.lit(7)), text), F.lit(" -0700")).alias("a"),
        F.concat(F.date_format(ts, text), F.lit(" Z")).alias("b"),
        F.date_format(ts, text).alias("c"),
    )
    return cells.select(
        "event_id", parse_ocsf_ts("a").alias("offset_time"), parse_ocsf_ts("b").alias("zulu_time"),
        parse_ocsf_ts("c").alias("naive_time"),
    )


def _database(spark) -> str:
    return f"veerline_{uuid.uuid4().hex}"


PRODUCTION = SETTINGS.with_(synthetic=False, partition_column="EVENT_DATE")


def _production(spark, sf) -> str:
    """A database with the OCSF-shaped tables by day, loaded in two steps that share a day."""
    name = _database(spark)
    tables = sources.create_tables(spark, name, partition_column="EVENT_DATE")
    rows = views.ocsf_network(spark, sf)
    for part in ("EVENT_TIME < TIMESTAMP_NTZ '2024-01-11 00:00:00'", "EVENT_TIME >= TIMESTAMP_NTZ '2024-01-10 00:00:00'"):
        sources.load_days(rows.filter(part), tables[0], "EVENT_DATE")
    sources.load_days(views.ocsf_process(spark, sf), tables[1], "EVENT_DATE")
    return name


@check("a3_read_sources", f"SELECT {NET_FLAT}, CAST(event_time AS DATE) AS event_date FROM net", times="event_time", dates="event_date")
def _(spark, sf):
    network_events, process_events = sources.read_sources(spark, PRODUCTION.with_(catalog=_production(spark, sf)))
    assert process_events is not None
    return network_events.withColumnRenamed("EVENT_DATE", "event_date").select(*NET_COLUMNS, "event_date")


@check("a9_declared_schema", f"SELECT event_id, {NET_FLAT}, is_anomaly FROM net", times="event_time")
def _(spark, sf):
    """Events written and read under the declared schema."""
    path = _scratch(spark, "declared")
    declared = [f for f in schemas.NETWORK_EVENTS if f.name in ("event_id", "is_anomaly", *NET_COLUMNS)]
    network(spark, sf).select(*[F.col(f.name).cast(f.dataType) for f in declared]).write.parquet(path)
    return sources.read_events(spark, path, schemas.NETWORK_EVENTS).select(*[f.name for f in declared])


@check("a10_create_tables", f"SELECT {PROC_FLAT}, CAST(event_time AS DATE) AS event_date FROM procx", times="event_time", dates="event_date")
def _(spark, sf):
    _, found = sources.read_sources(spark, PRODUCTION.with_(catalog=_production(spark, sf)))
    return found.withColumnRenamed("EVENT_DATE", "event_date").select(*PROC_COLUMNS, "event_date")


def _event_table(spark, sf) -> str:
    name = f"{_database(spark)}"
    spark.sql(f"CREATE DATABASE {name}")
    sinks.write_table(network(spark, sf), f"{name}.network")
    return f"{name}.network"


@check(
    "a11_describe",
    """SELECT unnest(['event_id', 'event_time', 'user', 'dest_port', 'is_anomaly']) AS col_name,
           unnest([typeof(event_id), typeof(event_time), typeof("user"), typeof(dest_port), typeof(is_anomaly)]) AS data_type
       FROM (SELECT * FROM net LIMIT 1) n""",
)
def _(spark, sf):
    names = {"timestamp_ntz": "TIMESTAMP", "string": "VARCHAR", "int": "INTEGER"}
    kind = F.upper("data_type")
    for mine, theirs in names.items():
        kind = F.when(F.col("data_type") == mine, theirs).otherwise(kind)
    rows = sources.describe(spark, _event_table(spark, sf)).select("col_name", kind.alias("data_type"))
    return rows.filter(F.col("col_name").isin("event_id", "event_time", "user", "dest_port", "is_anomaly")).distinct()


@check("l6_table_statistics", "SELECT count(*) AS rows FROM net")
def _(spark, sf):
    name = _event_table(spark, sf)
    sinks.analyze(spark, name)
    stats = sources.describe(spark, name).filter("col_name = 'Statistics'")
    return stats.select(F.regexp_extract("data_type", r"(\d+) rows", 1).cast("long").alias("rows"))


@check("i6_preview", "SELECT event_id, event_time, \"user\", bytes_out FROM net ORDER BY event_time, event_id LIMIT 20", times="event_time")
def _(spark, sf):
    return network(spark, sf).select("event_id", "event_time", "user", "bytes_out").orderBy("event_time", "event_id").limit(20)


@check(
    "a12_read_findings",
    """
    SELECT event_time, "user", finding_type, severity, title, risk_score, description FROM find
    WHERE severity IN ('CRITICAL', 'HIGH')
    """,
    "risk_score", times="event_time",
)
def _(spark, sf):
    return sources.read_findings(_detect(spark, sf).findings)


# --- B: filters and projections ----------------------------------------------------------


@check("b1_time_bounds", "SELECT * FROM b", times="baseline_start analysis_start analysis_end")
def _(spark, sf):
    return bd.time_bounds(network(spark, sf), SETTINGS)


@check(
    "b1_time_bounds_aligned",
    """
    SELECT date_trunc('day', baseline_start)::TIMESTAMP AS baseline_start,
           date_trunc('day', analysis_start)::TIMESTAMP AS analysis_start, analysis_end FROM b
    """,
    times="baseline_start analysis_start analysis_end",
)
def _(spark, sf):
    return bd.time_bounds(network(spark, sf), SETTINGS.with_(align_to_day=True))


@check(
    "b2_in_baseline",
    'SELECT event_id, event_time, "user", bytes_out FROM net_both WHERE period = \'baseline\'',
    times="event_time",
)
def _(spark, sf):
    events = bd.in_baseline(network(spark, sf), _bounds(spark, sf), SETTINGS)
    return events.select("event_id", "event_time", "user", "bytes_out")


@check(
    "b3_in_analysis",
    'SELECT event_id, event_time, "user", bytes_out FROM net_both WHERE period = \'analysis\'',
    times="event_time",
)
def _(spark, sf):
    events = bd.in_analysis(network(spark, sf), _bounds(spark, sf), SETTINGS)
    return events.select("event_id", "event_time", "user", "bytes_out")


@check(
    "b4_with_date",
    "SELECT CAST(event_time AS DATE) AS date, count(*) AS events FROM net GROUP BY 1",
    dates="date",
)
def _(spark, sf):
    return bd.with_date(network(spark, sf)).groupBy("date").agg(F.count(F.lit(1)).alias("events"))


@check("b6_projection", 'SELECT "user", baseline_avg_events, baseline_avg_bytes_out FROM net_base',
       "baseline_avg_events baseline_avg_bytes_out")
def _(spark, sf):
    return _baseline(spark, sf).select("user", "baseline_avg_events", "baseline_avg_bytes_out")


@check(
    "b7_zero_fill",
    """
    SELECT "user", baseline_avg_events, coalesce(baseline_std_events, 0) AS baseline_std_events,
           coalesce(baseline_std_bytes_out, 0) AS baseline_std_bytes_out FROM net_base
    """,
    "baseline_avg_events baseline_std_events baseline_std_bytes_out",
)
def _(spark, sf):
    return rk.zero_fill(
        _baseline(spark, sf).select("user", "baseline_avg_events", "baseline_std_events", "baseline_std_bytes_out")
    )


@check(
    "b8_anomalous_days",
    'SELECT "user", date, network_anomaly_score FROM net_sc WHERE network_anomaly_score >= 0.5::DOUBLE',
    "network_anomaly_score", "date",
)
def _(spark, sf):
    return scores.anomalous(_scored(spark, sf), "network_anomaly_score", SETTINGS).select(
        "user", "date", "network_anomaly_score"
    )


@check(
    "b9_high_risk_users",
    """
    SELECT "user", combined_risk_score, final_risk_level, peer_group FROM risk
    WHERE combined_risk_score >= 0.7::DOUBLE
    """,
    "combined_risk_score",
)
def _(spark, sf):
    return rk.high_risk_users(_detect(spark, sf).risk, SETTINGS).select(
        "user", "combined_risk_score", "final_risk_level", "peer_group"
    )


@check(
    "b10_high_band",
    """
    SELECT "user", date, network_anomaly_score FROM net_sc
    WHERE network_anomaly_score >= 0.7::DOUBLE AND network_anomaly_score < 0.85::DOUBLE
    """,
    "network_anomaly_score", "date",
)
def _(spark, sf):
    score = F.col("network_anomaly_score")
    return (
        _scored(spark, sf)
        .filter((score >= SETTINGS.high) & (score < SETTINGS.critical))
        .select("user", "date", "network_anomaly_score")
    )


@check(
    "b11_is_admin_process",
    """
    SELECT process_name, process_name IN ('powershell.exe','cmd.exe','bash','sudo','ssh') AS is_admin,
           count(*) AS runs FROM proc GROUP BY 1, 2
    """,
)
def _(spark, sf):
    return (
        process(spark, sf)
        .groupBy("process_name", is_admin_process().alias("is_admin"))
        .agg(F.count(F.lit(1)).alias("runs"))
    )


@check(
    "b12_is_suspicious_process",
    """
    SELECT event_id, "user", process_name FROM proc WHERE process_name IN (
      'mimikatz.exe', 'psexec.exe', 'nc.exe', 'nmap.exe', 'metasploit.exe', 'cobalt.exe',
      'ncat', 'socat', 'nmap', 'sqlmap', 'john', 'hashcat', 'metasploit')
    """,
)
def _(spark, sf):
    return process(spark, sf).filter(is_suspicious_process()).select("event_id", "user", "process_name")


@check("b13_labelled", 'SELECT event_id, "user", bytes_out FROM net WHERE is_anomaly')
def _(spark, sf):
    return rules.labelled(network(spark, sf)).select("event_id", "user", "bytes_out")


@check(
    "b14_by_severity",
    "SELECT finding_id, severity, risk_score FROM find WHERE severity IN ('HIGH', 'CRITICAL')",
    "risk_score",
)
def _(spark, sf):
    return fd.by_severity(_detect(spark, sf).findings, ("HIGH", "CRITICAL")).select(
        "finding_id", "severity", "risk_score"
    )


@check(
    "b15_drill_network",
    f"""
    SELECT event_time, dest_host, dest_ip, dest_port, bytes_out, session_duration FROM net
    WHERE "user" = '{USER}' AND event_time >= TIMESTAMP '{SINCE} 00:00:00'
    """,
    times="event_time",
)
def _(spark, sf):
    return enrich.drill_network(network(spark, sf), USER, SINCE)


@check(
    "b16_drill_process",
    f"""
    SELECT event_time, process_name, cmd_line, md5_hash FROM procx
    WHERE "user" = '{USER}' AND event_time >= TIMESTAMP '{SINCE} 00:00:00'
    """,
    times="event_time",
)
def _(spark, sf):
    return enrich.drill_process(process(spark, sf), USER, SINCE)


@check(
    "b17_ensure_features",
    """
    SELECT "user", baseline_avg_events, coalesce(baseline_std_events, 0) AS baseline_std_events,
           0.0::DOUBLE AS baseline_avg_bytes_out, 0.0::DOUBLE AS baseline_std_bytes_out,
           0.0::DOUBLE AS baseline_avg_destinations, 0.0::DOUBLE AS baseline_std_destinations,
           0.0::DOUBLE AS baseline_typical_start_hour, 0.0::DOUBLE AS baseline_typical_end_hour,
           0.0::DOUBLE AS peer_group
    FROM net_base
    """,
    "baseline_avg_events baseline_std_events",
)
def _(spark, sf):
    return model.ensure_features(_baseline(spark, sf).select("user", "baseline_avg_events", "baseline_std_events"))


@check("b19_ensure_ids", "SELECT vec_id, anomaly_score, 'unknown' AS \"user\", -1 AS peer_group FROM vec", "anomaly_score")
def _(spark, sf):
    return model.ensure_ids(_vectors(spark, sf))


# --- C: aggregations ---------------------------------------------------------------------


@check(
    "c1_daily_network",
    f"SELECT \"user\", date, {WIDE_SQL} FROM net_daily WHERE period = 'baseline'",
    "avg_session_duration", "date",
)
def _(spark, sf):
    return features.daily_network(bd.in_baseline(network(spark, sf), _bounds(spark, sf), SETTINGS))


@check(
    "c2_daily_network_narrow",
    f"SELECT \"user\", date, {', '.join(features.NARROW)} FROM net_daily WHERE period = 'baseline'",
    dates="date",
)
def _(spark, sf):
    events = bd.in_baseline(network(spark, sf), _bounds(spark, sf), SETTINGS)
    return features.daily_network(events, features.NARROW)


BASE_DOUBLES = (
    "baseline_avg_events baseline_std_events baseline_avg_bytes_out baseline_std_bytes_out"
    " baseline_avg_destinations baseline_std_destinations baseline_typical_start_hour baseline_typical_end_hour"
)


@check(
    "c3_user_baseline_network", "SELECT * FROM net_base",
    BASE_DOUBLES + " baseline_avg_hosts baseline_std_hosts baseline_avg_active_hours",
)
def _(spark, sf):
    return _baseline(spark, sf)


@check(
    "c4_user_baseline_narrow",
    f"SELECT \"user\", {', '.join(baseline.NARROW_BASELINE)} FROM net_base", BASE_DOUBLES,
)
def _(spark, sf):
    events = bd.in_baseline(network(spark, sf), _bounds(spark, sf), SETTINGS)
    return baseline.user_baseline_narrow(features.daily_network(events))


@check(
    "c5_daily_process",
    f"SELECT \"user\", date, {PROCESS_SQL} FROM proc_daily WHERE period = 'baseline'", dates="date",
)
def _(spark, sf):
    return features.daily_process(bd.in_baseline(process(spark, sf), _bounds(spark, sf), SETTINGS), SETTINGS)


@check(
    "c6_user_baseline_process", "SELECT * FROM proc_base",
    "baseline_avg_processes baseline_std_processes baseline_avg_unique_processes"
    " baseline_std_unique_processes baseline_avg_admin_processes baseline_std_admin_processes",
)
def _(spark, sf):
    return _process_baseline(spark, sf)


@check(
    "c7_daily_network_analysis",
    f"SELECT \"user\", date, {', '.join(features.WIDE_ANALYSIS)} FROM net_daily WHERE period = 'analysis'",
    dates="date",
)
def _(spark, sf):
    return _analysis(spark, sf)


@check(
    "c8_daily_process_analysis",
    f"SELECT \"user\", date, {', '.join(features.PROCESS_ANALYSIS)} FROM proc_daily WHERE period = 'analysis'",
    dates="date",
)
def _(spark, sf):
    return _process_analysis(spark, sf)


@check(
    "c9_daily_network_periods", f'SELECT "user", date, period, {WIDE_SQL} FROM net_daily',
    "avg_session_duration", "date",
)
def _(spark, sf):
    return features.daily_network_periods(network(spark, sf), _bounds(spark, sf), SETTINGS)


@check(
    "c9_daily_process_periods", f'SELECT "user", date, period, {PROCESS_SQL} FROM proc_daily', dates="date",
)
def _(spark, sf):
    return features.daily_process_periods(process(spark, sf), _bounds(spark, sf), SETTINGS)


@check(
    "c10_labelled_counts",
    """
    SELECT "user", CAST(event_time AS DATE) AS date, count(*) FILTER (WHERE is_anomaly) AS known_anomalies
    FROM net GROUP BY 1, 2
    """,
    dates="date",
)
def _(spark, sf):
    return features.labelled_counts(network(spark, sf))


@check(
    "c11_feature_ranges",
    """
    SELECT min_e AS min_baseline_avg_events, min_b AS min_baseline_avg_bytes_out,
           max_e AS max_baseline_avg_events, max_b AS max_baseline_avg_bytes_out FROM ranges
    """,
    "min_baseline_avg_events min_baseline_avg_bytes_out max_baseline_avg_events max_baseline_avg_bytes_out",
)
def _(spark, sf):
    return pr.feature_ranges(_baseline(spark, sf), pr.TWO_FEATURES)


@check(
    "c12_peer_profile",
    """
    SELECT peer_group, count(*) AS users, avg(baseline_avg_events) AS avg_events,
           avg(baseline_avg_bytes_out) AS avg_bytes_out FROM peers JOIN net_base USING ("user") GROUP BY peer_group
    """,
    "avg_events avg_bytes_out",
)
def _(spark, sf):
    base = sinks.materialise(_baseline(spark, sf), "baseline")
    return pr.peer_profile(_peers_of(base), base)


@check("c13_user_network_risk", "SELECT * FROM net_risk", "max_network_risk")
def _(spark, sf):
    return rk.user_network_risk(_scored(spark, sf), SETTINGS)


@check("c14_user_process_risk", "SELECT * FROM proc_risk", "max_process_risk")
def _(spark, sf):
    return rk.user_process_risk(_process_scored(spark, sf), SETTINGS)


@check(
    "c15_anomaly_stats",
    """
    SELECT count(*) FILTER (WHERE network_anomaly_score >= 0.5::DOUBLE) AS total_anomalies,
           count(*) FILTER (WHERE network_anomaly_score >= 0.85::DOUBLE) AS critical_anomalies,
           count(*) FILTER (WHERE network_anomaly_score >= 0.7::DOUBLE AND network_anomaly_score < 0.85::DOUBLE)
             AS high_anomalies
    FROM net_sc
    """,
)
def _(spark, sf):
    return rk.anomaly_stats(_scored(spark, sf), settings=SETTINGS)


@check("c16_risk_distribution", 'SELECT final_risk_level, count(*) AS "count" FROM risk GROUP BY 1')
def _(spark, sf):
    return rk.risk_distribution(_detect(spark, sf).risk)


SEVERITY_SQL = """
    SELECT l.severity, count(f.finding_id) AS findings
    FROM (VALUES ('CRITICAL'), ('HIGH'), ('MEDIUM'), ('LOW')) AS l(severity)
    LEFT JOIN find f ON f.severity = l.severity GROUP BY l.severity
"""


@check("c17_findings_by_severity", SEVERITY_SQL)
def _(spark, sf):
    return reports.findings_by_severity(_detect(spark, sf).findings)


@check(
    "c18_findings_by_type",
    'SELECT finding_type, severity, count(*) AS "count" FROM find GROUP BY finding_type, severity',
)
def _(spark, sf):
    return reports.findings_by_type(_detect(spark, sf).findings)


@check(
    "c19_daily_high_risk",
    """
    SELECT CAST(event_time AS DATE) AS date, count(*) AS findings, count(DISTINCT "user") AS users
    FROM find WHERE severity IN ('HIGH', 'CRITICAL') GROUP BY 1
    """,
    dates="date",
)
def _(spark, sf):
    return reports.daily_high_risk(_detect(spark, sf).findings)


@check("c20_user_activity", 'SELECT "user", count(*) AS "count" FROM net GROUP BY "user"')
def _(spark, sf):
    return reports.user_activity(network(spark, sf))


@check("c21_hourly_pattern", 'SELECT CAST(hour(event_time) AS INTEGER) AS hour, count(*) AS "count" FROM net GROUP BY 1')
def _(spark, sf):
    return reports.hourly_pattern(network(spark, sf))


@check(
    "c22_labelled_summary",
    """
    SELECT "user", count(*) AS anomalous_events,
           coalesce(string_agg(DISTINCT anomaly_reason, ',' ORDER BY anomaly_reason), '') AS anomaly_types
    FROM netr WHERE is_anomaly GROUP BY "user"
    """,
)
def _(spark, sf):
    return reports.labelled_summary(_reasoned(spark, sf))


PROFILE_SQL = """
    SELECT count(*) AS events, count(*) FILTER (WHERE is_anomaly) AS anomalous_events,
           count(*) FILTER (WHERE is_anomaly) * 100.0::DOUBLE / count(*) AS anomalous_percent,
           count(DISTINCT "user") AS unique_users, count(DISTINCT {0}) AS unique_{0} FROM {1}
"""


@check("c23_data_profile_network", PROFILE_SQL.format("dest_host", "net"), "anomalous_percent")
def _(spark, sf):
    return reports.data_profile(network(spark, sf))


@check("c23_data_profile_process", PROFILE_SQL.format("process_name", "proc"), "anomalous_percent")
def _(spark, sf):
    return reports.data_profile(process(spark, sf), "process_name")


@check(
    "c24_period_counts",
    """
    SELECT count(*) FILTER (WHERE period = 'baseline') AS baseline_events,
           count(*) FILTER (WHERE period = 'analysis') AS analysis_events FROM net_both
    """,
)
def _(spark, sf):
    return bd.period_counts(network(spark, sf), _bounds(spark, sf), SETTINGS)


@check("c25_counts", 'SELECT count(*) AS rows, count(DISTINCT "user") AS users FROM net')
def _(spark, sf):
    return reports.row_and_user_counts(network(spark, sf))


@check(
    "c26_geo_features",
    """
    SELECT "user", CAST(event_time AS DATE) AS date, count(DISTINCT s.n_name) AS unique_countries,
           count(DISTINCT d.n_name) AS dest_countries
    FROM net JOIN nation s ON s.n_nationkey = user_id % 25 JOIN nation d ON d.n_nationkey = k % 25
    GROUP BY 1, 2
    """,
    dates="date",
)
def _(spark, sf):
    return features.with_geo_features(views.network_with_countries(spark, sf))


@check(
    "c27_rates",
    """SELECT avg(CASE WHEN combined_risk_score >= 0.7::DOUBLE THEN 1 ELSE 0 END) AS high_risk_rate,
              any_value(n) AS model_anomalies, any_value(share) AS model_anomaly_rate
       FROM risk, (SELECT count(*) FILTER (WHERE anomaly_score < q) AS n,
                          count(*) FILTER (WHERE anomaly_score < q)::DOUBLE / count(*) AS share
                   FROM vec, (SELECT quantile_cont(anomaly_score, 0.1) AS q FROM vec) t) m""",
    "high_risk_rate model_anomaly_rate",
)
def _(spark, sf):
    vectors = _vectors(spark, sf)
    flagged = model.flag_anomalies(vectors, model.threshold_at(vectors, 0.1))
    return reports.rates(_detect(spark, sf).risk, SETTINGS, flagged)


@check(
    "c28_daily_lateral",
    """
    SELECT "user", CAST(event_time AS DATE) AS date,
           count(DISTINCT CASE WHEN dest_ip LIKE '10.%' THEN dest_ip END) AS internal_destinations,
           count(DISTINCT dest_port) AS unique_ports,
           count(*) FILTER (WHERE dest_port = 22) AS port_22_events,
           count(*) FILTER (WHERE dest_port = 445) AS port_445_events,
           count(*) FILTER (WHERE dest_port = 3389) AS port_3389_events
    FROM net GROUP BY 1, 2
    """,
    dates="date",
)
def _(spark, sf):
    return features.daily_lateral(network(spark, sf), SETTINGS)


# --- D: joins ----------------------------------------------------------------------------


@check(
    "d1_attach_baseline",
    """
    SELECT "user", date, daily_events, baseline_avg_events, baseline_std_events, baseline_avg_bytes_out
    FROM net_joined
    """,
    "baseline_avg_events baseline_std_events baseline_avg_bytes_out", "date",
)
def _(spark, sf):
    return scores.attach_baseline(_analysis(spark, sf), _baseline(spark, sf)).select(
        "user", "date", "daily_events", "baseline_avg_events", "baseline_std_events", "baseline_avg_bytes_out"
    )


@check("d2_attach_peers", 'SELECT "user", date, daily_events, peer_group FROM net_joined', dates="date")
def _(spark, sf):
    base = _baseline(spark, sf)
    return scores.attach_peers(_analysis(spark, sf), _peers_of(base)).select("user", "date", "daily_events", "peer_group")


@check(
    "d3_attach_process_baseline",
    'SELECT "user", date, daily_processes, baseline_avg_processes, baseline_std_processes FROM proc_z',
    "baseline_avg_processes baseline_std_processes", "date",
)
def _(spark, sf):
    return scores.attach_baseline(_process_analysis(spark, sf), _process_baseline(spark, sf)).select(
        "user", "date", "daily_processes", "baseline_avg_processes", "baseline_std_processes"
    )


@check("d4_combine_risk", "SELECT * FROM combined", "max_network_risk max_process_risk")
def _(spark, sf):
    return rk.combine_risk(
        rk.user_network_risk(_scored(spark, sf), SETTINGS), rk.user_process_risk(_process_scored(spark, sf), SETTINGS)
    )


RISK_SQL = """
    SELECT "user", max_network_risk, max_process_risk, combined_risk_score, peer_group, final_risk_level FROM risk
"""


@check("d5_risk_with_peers", RISK_SQL, "max_network_risk max_process_risk combined_risk_score")
def _(spark, sf):
    return _detect(spark, sf).risk.select(
        "user", "max_network_risk", "max_process_risk", "combined_risk_score", "peer_group", "final_risk_level"
    )


@check(
    "d6_with_user_level",
    """
    SELECT s."user", date, network_anomaly_score, r.peer_group, final_risk_level
    FROM net_sc s JOIN risk r ON s."user" = r."user" WHERE network_anomaly_score >= 0.5::DOUBLE
    """,
    "network_anomaly_score", "date",
)
def _(spark, sf):
    d = _detect(spark, sf)
    rows = scores.anomalous(d.scored_network, "network_anomaly_score", SETTINGS)
    return rk.with_user_level(rows, d.risk).select(
        "user", "date", "network_anomaly_score", "peer_group", "final_risk_level"
    )


FEATURE_DOUBLES = BASE_DOUBLES + " combined_risk_score"
FEATURE_SQL = "SELECT * FROM feats"


@check("d8_ml_features", FEATURE_SQL, FEATURE_DOUBLES)
def _(spark, sf):
    return _features(spark, sf)


FEED_SQL = """
    SELECT event_id, net.dest_ip, threat_level, threat_level IS NOT NULL AS threat_match
    FROM net LEFT JOIN feed ON net.dest_ip = feed.dest_ip
"""


def _feed(spark, sf):
    """A feed of addresses that received large transfers."""
    return (
        network(spark, sf).filter(F.col("bytes_out") >= 30_000).select("dest_ip").distinct()
        .withColumn("threat_level", F.lit("high"))
    )


@check(
    "d9_threat_any",
    """SELECT event_id, threat_kinds <> '' AS threat_match, threat_kinds FROM (
         SELECT event_id, concat_ws(',', CASE WHEN dest_host = 'signup.example' THEN 'domain' END,
                                    CASE WHEN dest_ip IN (SELECT dest_ip FROM feed) OR src_ip = '10.0.0.6' THEN 'ip' END) AS threat_kinds
         FROM net) t""",
)
def _(spark, sf):
    """Addresses and domains of one feed, over two address columns and the host."""
    listed = _feed(spark, sf).select(F.lit("ip").alias("kind"), F.col("dest_ip").alias("value"))
    more = spark.createDataFrame([("ip", "10.0.0.6"), ("domain", "SIGNUP.example"), ("ip", None)], "kind string, value string")
    keys = {"ip": ("dest_ip", "src_ip"), "domain": ("dest_host",)}
    found = enrich.enrich_threat_any(network(spark, sf), listed.unionByName(more), keys, settings=SETTINGS)
    return found.select("event_id", "threat_match", "threat_kinds")


@check("d9_enrich_threat_intel", FEED_SQL)
def _(spark, sf):
    return enrich.enrich_threat_intel(network(spark, sf), _feed(spark, sf), "dest_ip", settings=SETTINGS).select(
        "event_id", "dest_ip", "threat_level", "threat_match"
    )


@check(
    "d9_threat_hits",
    'SELECT event_id, "user", dest_ip FROM net WHERE dest_ip IN (SELECT dest_ip FROM feed)',
)
def _(spark, sf):
    return enrich.threat_hits(network(spark, sf), _feed(spark, sf), "dest_ip", settings=SETTINGS).select(
        "event_id", "user", "dest_ip"
    )


@check(
    "d10_suppress_allowlisted",
    """
    SELECT finding_id, "user", severity FROM find
    WHERE "user" NOT IN (SELECT "user" FROM net WHERE bytes_out >= 40000)
    """,
)
def _(spark, sf):
    allow = network(spark, sf).filter(F.col("bytes_out") >= 40_000).select("user")
    return enrich.suppress_allowlisted(_detect(spark, sf).findings, allow).select("finding_id", "user", "severity")


@check(
    "d11_new_destinations",
    """
    SELECT "user", dest_ip, min(event_time) AS first_seen, count(*) AS events
    FROM net_both a WHERE period = 'analysis' AND NOT EXISTS (
      SELECT 1 FROM net_both p WHERE p.period = 'baseline' AND p."user" = a."user" AND p.dest_ip = a.dest_ip)
    GROUP BY "user", dest_ip
    """,
    times="first_seen",
)
def _(spark, sf):
    return enrich.new_destinations(network(spark, sf), _bounds(spark, sf), SETTINGS)


FALLBACK_CTE = """
    SELECT d."user", date, daily_events, daily_bytes_out, unique_destinations, unique_hosts,
           first_activity_hour, last_activity_hour, ro.peer_group,
           CASE WHEN o."user" IS NOT NULL THEN 'own' WHEN g.peer_group IS NOT NULL THEN 'peer' ELSE 'global' END
             AS baseline_source,
           {columns}
    FROM net_daily d
    LEFT JOIN net_base o ON o."user" = d."user"
    LEFT JOIN roles ro ON ro."user" = d."user"
    LEFT JOIN (SELECT peer_group, {means} FROM net_base JOIN peers USING ("user") GROUP BY peer_group) g
      ON g.peer_group = ro.peer_group
    CROSS JOIN (SELECT {means} FROM net_base) a
    WHERE period = 'analysis'
"""
FALLBACK_COLUMNS = [
    "baseline_avg_events", "baseline_std_events", "baseline_avg_bytes_out", "baseline_std_bytes_out",
    "baseline_avg_destinations", "baseline_std_destinations", "baseline_avg_hosts", "baseline_std_hosts",
    "baseline_typical_start_hour", "baseline_typical_end_hour",
]
FALLBACK_SQL = FALLBACK_CTE.format(
    means=", ".join(f"avg({c}) AS {c}" for c in FALLBACK_COLUMNS),
    columns=", ".join(
        f'CASE WHEN o."user" IS NOT NULL THEN o.{c} WHEN g.peer_group IS NOT NULL THEN g.{c} ELSE a.{c} END AS {c}'
        for c in FALLBACK_COLUMNS
    ),
)


def _with_fallback(spark, sf):
    """Two of the new accounts have a known role; the others fall back to all users."""
    base = sinks.materialise(_baseline(spark, sf), "baseline")
    known = network(spark, sf).filter(F.col("user").isin("new1", "new2")).select("user").distinct()
    roles = _peers_of(base).unionByName(known.withColumn("peer_group", F.lit(2)))
    return scores.with_peer_fallback(_analysis(spark, sf), base, roles, SETTINGS)


@check(
    "d12_peer_fallback",
    f'SELECT "user", date, peer_group, baseline_source, {", ".join(FALLBACK_COLUMNS)} FROM ({FALLBACK_SQL}) f',
    " ".join(FALLBACK_COLUMNS), "date",
)
def _(spark, sf):
    return _with_fallback(spark, sf).select("user", "date", "peer_group", "baseline_source", *FALLBACK_COLUMNS)


PLACED = """(
    SELECT "user", peer_group FROM peers
    UNION ALL
    SELECT "user", g AS peer_group FROM (
      SELECT m."user", c.peer_group AS g, row_number() OVER (PARTITION BY m."user" ORDER BY (e - v) * (e - v) + (o - v) * (o - v), c.peer_group) AS k
      FROM (SELECT "user", (avg(daily_events) - any_value(min_e)) / (any_value(max_e) - any_value(min_e)) AS e,
                   (avg(daily_bytes_out) - any_value(min_b)) / (any_value(max_b) - any_value(min_b)) AS o
            FROM net_daily, ranges WHERE period = 'analysis' AND "user" NOT IN (SELECT "user" FROM net_base) GROUP BY "user") m,
           centroids c) n WHERE k = 1)"""


@check(
    "d12_detect_cold_start",
    f"""SELECT "user", date, peer_group, baseline_source, {", ".join(FALLBACK_COLUMNS)}
        FROM ({FALLBACK_SQL.replace("JOIN roles", f"JOIN {PLACED}")}) f""",
    " ".join(FALLBACK_COLUMNS), "date",
)
def _(spark, sf):
    """New users are placed among the peers by the analysis itself."""
    found = detect(network(spark, sf), process(spark, sf), SETTINGS.with_(peer_fallback=True), _peer_model)
    return found.scored_network.select("user", "date", "peer_group", "baseline_source", *FALLBACK_COLUMNS)


# --- E: scores ---------------------------------------------------------------------------

Z_NET = "events_zscore bytes_out_zscore destinations_zscore hosts_zscore"
Z_PROC = "processes_zscore unique_processes_zscore admin_processes_zscore"


def _sql_list(names: str) -> str:
    return ", ".join(names.split())


@check("e1_zscores", f'SELECT "user", date, {_sql_list(Z_NET)} FROM net_sc', Z_NET, "date")
def _(spark, sf):
    return _scored(spark, sf).select("user", "date", *Z_NET.split())


@check(
    "e1_signed_zscores",
    """
    SELECT "user", date, coalesce(CASE WHEN baseline_std_events > 0
             THEN (daily_events - baseline_avg_events) / baseline_std_events END, 0) AS events_zscore
    FROM net_joined
    """,
    "events_zscore", "date",
)
def _(spark, sf):
    return _scored(spark, sf, SETTINGS.with_(signed_zscore=True)).select("user", "date", "events_zscore")


@check("e2_after_hours", 'SELECT "user", date, after_hours_anomaly FROM net_sc', "after_hours_anomaly", "date")
def _(spark, sf):
    return _scored(spark, sf).select("user", "date", "after_hours_anomaly")


@check(
    "e3_capped_terms",
    """
    SELECT "user", date, least(events_zscore / 3.0::DOUBLE, 1.0::DOUBLE) * 0.2::DOUBLE AS events_term,
           least(bytes_out_zscore / 3.0::DOUBLE, 1.0::DOUBLE) * 0.4::DOUBLE AS bytes_out_term FROM net_sc
    """,
    "events_term bytes_out_term", "date",
)
def _(spark, sf):
    return _scored(spark, sf).select(
        "user", "date", capped("events_zscore", 0.2).alias("events_term"),
        capped("bytes_out_zscore", 0.4).alias("bytes_out_term"),
    )


NET_SCORE = "user date network_anomaly_score network_anomaly_level".split()


@check(
    "e4_network_score_five_term",
    'SELECT "user", date, network_anomaly_score, network_anomaly_level FROM net_sc',
    "network_anomaly_score", "date",
)
def _(spark, sf):
    return _scored(spark, sf).select(*NET_SCORE)


@check(
    "e5_network_score_four_term",
    """
    SELECT "user", date, four_score AS network_anomaly_score,
           CASE WHEN four_score >= 0.85::DOUBLE THEN 'CRITICAL' WHEN four_score >= 0.7::DOUBLE THEN 'HIGH'
                WHEN four_score >= 0.5::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS network_anomaly_level
    FROM net_sc
    """,
    "network_anomaly_score", "date",
)
def _(spark, sf):
    return _scored(spark, sf, SETTINGS.with_(profile=FOUR_TERM)).select(*NET_SCORE)


@check(
    "e6_process_score",
    f'SELECT "user", date, {_sql_list(Z_PROC)}, process_anomaly_score, process_anomaly_level FROM proc_sc',
    Z_PROC + " process_anomaly_score", "date",
)
def _(spark, sf):
    return _process_scored(spark, sf).select(
        "user", "date", *Z_PROC.split(), "process_anomaly_score", "process_anomaly_level"
    )


@check(
    "e7_risk_level",
    """
    SELECT vec_id, CASE WHEN abs(anomaly_score) >= 0.85::DOUBLE THEN 'CRITICAL'
      WHEN abs(anomaly_score) >= 0.7::DOUBLE THEN 'HIGH' WHEN abs(anomaly_score) >= 0.5::DOUBLE THEN 'MEDIUM'
      ELSE 'LOW' END AS level FROM vec
    """,
)
def _(spark, sf):
    return _vectors(spark, sf).select("vec_id", ladder(F.abs("anomaly_score"), SETTINGS).alias("level"))


@check("e8_combined_risk", 'SELECT "user", combined_risk_score, final_risk_level FROM risk', "combined_risk_score")
def _(spark, sf):
    return rk.user_risk(_scored(spark, sf), _process_scored(spark, sf), None, SETTINGS).select(
        "user", "combined_risk_score", "final_risk_level"
    )


@check(
    "e8_combined_risk_network_only",
    """
    SELECT "user", max_network_risk AS combined_risk_score,
           CASE WHEN max_network_risk >= 0.85::DOUBLE THEN 'CRITICAL' WHEN max_network_risk >= 0.7::DOUBLE THEN 'HIGH'
                WHEN max_network_risk >= 0.5::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS final_risk_level
    FROM net_risk
    """,
    "combined_risk_score",
)
def _(spark, sf):
    return rk.user_risk(_scored(spark, sf), None, None, SETTINGS).select(
        "user", "combined_risk_score", "final_risk_level"
    )


@check(
    "e9_outliers",
    """
    SELECT * FROM (
      SELECT "user", date, metric, zscore, CASE WHEN zscore > 4 THEN 'very_strong' WHEN zscore > 3 THEN 'strong'
             WHEN zscore > 2.5 THEN 'potential' END AS strength
      FROM (SELECT "user", date, events_zscore, bytes_out_zscore, destinations_zscore, hosts_zscore FROM net_sc)
      UNPIVOT (zscore FOR metric IN (events_zscore, bytes_out_zscore, destinations_zscore, hosts_zscore))
    ) WHERE strength IS NOT NULL
    """,
    "zscore", "date",
)
def _(spark, sf):
    return scores.outliers(_scored(spark, sf), SETTINGS)


@check("e10_minmax", "SELECT * FROM norm", " ".join(NORMS))
def _(spark, sf):
    return pr.normalised(_baseline(spark, sf)).select("user", *NORMS)


@check(
    "e11_standardize",
    """
    SELECT "user",
           (baseline_avg_events - m) / CASE WHEN s > 0 THEN s ELSE 1 END AS std_baseline_avg_events,
           (baseline_avg_bytes_out - mb) / CASE WHEN sb > 0 THEN sb ELSE 1 END AS std_baseline_avg_bytes_out
    FROM net_base, (SELECT avg(baseline_avg_events) AS m, stddev_pop(baseline_avg_events) AS s,
                           avg(baseline_avg_bytes_out) AS mb, stddev_pop(baseline_avg_bytes_out) AS sb FROM net_base) p
    """,
    "std_baseline_avg_events std_baseline_avg_bytes_out",
)
def _(spark, sf):
    base = sinks.materialise(_baseline(spark, sf), "baseline")
    params = pr.scaler_stats(base, pr.TWO_FEATURES).first().asDict()
    return pr.standardize(base, pr.TWO_FEATURES, params).select(
        "user", "std_baseline_avg_events", "std_baseline_avg_bytes_out"
    )


@check("e12_anomaly_reason", "SELECT event_id, anomaly_reason FROM netr")
def _(spark, sf):
    return _reasoned(spark, sf).select("event_id", "anomaly_reason")


@check(
    "e13_rule_severity",
    """
    SELECT severity, risk_score, count(*) AS n FROM
      (SELECT severity, risk_score FROM rule_net UNION ALL SELECT severity, risk_score FROM rule_proc) r
    GROUP BY 1, 2
    """,
    "risk_score",
)
def _(spark, sf):
    both = rules.rule_network(_reasoned(spark, sf)).unionByName(
        rules.rule_process(process(spark, sf)), allowMissingColumns=True
    )
    return both.groupBy("severity", "risk_score").agg(F.count(F.lit(1)).alias("n"))


@check(
    "e14_peer_deviation",
    """
    SELECT "user", peer_group, ze AS peer_z_baseline_avg_events, zb AS peer_z_baseline_avg_bytes_out,
           greatest(ze, zb) AS peer_zscore
    FROM (
      SELECT u."user", u.peer_group,
             coalesce(CASE WHEN se > 0 THEN abs(baseline_avg_events - me) / se END, 0) AS ze,
             coalesce(CASE WHEN sb > 0 THEN abs(baseline_avg_bytes_out - mb) / sb END, 0) AS zb
      FROM (SELECT * FROM net_base JOIN peers USING ("user")) u JOIN (
        SELECT peer_group, avg(baseline_avg_events) AS me, stddev_samp(baseline_avg_events) AS se,
               avg(baseline_avg_bytes_out) AS mb, stddev_samp(baseline_avg_bytes_out) AS sb
        FROM net_base JOIN peers USING ("user") GROUP BY peer_group) g ON g.peer_group = u.peer_group
    ) z
    """,
    "peer_z_baseline_avg_events peer_z_baseline_avg_bytes_out peer_zscore",
)
def _(spark, sf):
    base = sinks.materialise(_baseline(spark, sf), "baseline")
    return pr.peer_deviation(base, _peers_of(base), settings=SETTINGS)


@check(
    "e14_peer_distance",
    'SELECT "user", peer_group, sqrt(sq) AS peer_distance FROM assigned', "peer_distance",
)
def _(spark, sf):
    return _assigned(_baseline(spark, sf)).select("user", "peer_group", "peer_distance")


@check(
    "e15_score_with_fallback",
    f"""
    SELECT "user", date, baseline_source,
           least(coalesce(CASE WHEN baseline_std_events > 0
             THEN abs(daily_events - baseline_avg_events) / baseline_std_events END, 0) / 3.0::DOUBLE, 1) * 0.2::DOUBLE
         + least(coalesce(CASE WHEN baseline_std_bytes_out > 0
             THEN abs(daily_bytes_out - baseline_avg_bytes_out) / baseline_std_bytes_out END, 0) / 3.0::DOUBLE, 1)
             * 0.4::DOUBLE
         + least(coalesce(CASE WHEN baseline_std_destinations > 0
             THEN abs(unique_destinations - baseline_avg_destinations) / baseline_std_destinations END, 0)
             / 3.0::DOUBLE, 1) * 0.2::DOUBLE
         + least(coalesce(CASE WHEN baseline_std_hosts > 0
             THEN abs(unique_hosts - baseline_avg_hosts) / baseline_std_hosts END, 0) / 3.0::DOUBLE, 1) * 0.1::DOUBLE
         + CASE WHEN first_activity_hour < baseline_typical_start_hour - 2
                  OR last_activity_hour > baseline_typical_end_hour + 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
             * 0.1::DOUBLE AS network_anomaly_score
    FROM ({FALLBACK_SQL}) f
    """,
    "network_anomaly_score", "date",
)
def _(spark, sf):
    return scores.network_score(_with_fallback(spark, sf), SETTINGS).select(
        "user", "date", "baseline_source", "network_anomaly_score"
    )


@check(
    "e16_stamp",
    "SELECT \"user\", combined_risk_score, TIMESTAMP '2024-02-01 06:00:00' AS analysis_timestamp FROM risk",
    "combined_risk_score", times="analysis_timestamp",
)
def _(spark, sf):
    return rk.stamp(_detect(spark, sf).risk, "2024-02-01 06:00:00").select(
        "user", "combined_risk_score", "analysis_timestamp"
    )


@check(
    "e17_tuned_settings",
    """
    SELECT "user", max_network_risk * 0.4::DOUBLE + max_process_risk * 0.6::DOUBLE AS combined_risk_score,
           CASE WHEN max_network_risk * 0.4::DOUBLE + max_process_risk * 0.6::DOUBLE >= 0.9::DOUBLE THEN 'CRITICAL'
                WHEN max_network_risk * 0.4::DOUBLE + max_process_risk * 0.6::DOUBLE >= 0.6::DOUBLE THEN 'HIGH'
                WHEN max_network_risk * 0.4::DOUBLE + max_process_risk * 0.6::DOUBLE >= 0.3::DOUBLE THEN 'MEDIUM'
                ELSE 'LOW' END AS final_risk_level
    FROM combined
    """,
    "combined_risk_score",
)
def _(spark, sf):
    tuned = SETTINGS.with_(network_weight=0.4, process_weight=0.6, medium=0.3, high=0.6, critical=0.9)
    return rk.user_risk(_scored(spark, sf), _process_scored(spark, sf), None, tuned).select(
        "user", "combined_risk_score", "final_risk_level"
    )


@check(
    "e18_rolling_baseline",
    """
    SELECT "user", date, daily_events, daily_bytes_out, unique_destinations,
           avg(daily_events) OVER w AS rolling_avg_daily_events,
           stddev_samp(daily_events) OVER w AS rolling_std_daily_events,
           avg(daily_bytes_out) OVER w AS rolling_avg_daily_bytes_out,
           stddev_samp(daily_bytes_out) OVER w AS rolling_std_daily_bytes_out,
           avg(unique_destinations) OVER w AS rolling_avg_unique_destinations,
           stddev_samp(unique_destinations) OVER w AS rolling_std_unique_destinations,
           count(*) OVER w AS rolling_days
    FROM user_hist
    WINDOW w AS (PARTITION BY "user" ORDER BY date RANGE BETWEEN INTERVAL 21 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING)
    """,
    "rolling_avg_daily_events rolling_std_daily_events rolling_avg_daily_bytes_out rolling_std_daily_bytes_out"
    " rolling_avg_unique_destinations rolling_std_unique_destinations",
    "date",
)
def _(spark, sf):
    daily = features.daily_network(network(spark, sf), ("daily_events", "daily_bytes_out", "unique_destinations"))
    return baseline.rolling_baseline(daily)


@check(
    "e19_data_gaps",
    """
    SELECT u."user", CAST(c.d AS DATE) AS date
    FROM (SELECT DISTINCT "user" FROM net_both) u,
         (SELECT unnest(generate_series(date_trunc('day', baseline_start)::TIMESTAMP,
                                        date_trunc('day', analysis_end)::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM b) c
    WHERE NOT EXISTS (SELECT 1 FROM net_both n WHERE n."user" = u."user" AND n.date = CAST(c.d AS DATE))
    """,
    dates="date",
)
def _(spark, sf):
    return enrich.data_gaps(network(spark, sf), _bounds(spark, sf), SETTINGS)


@check(
    "e14_daily_peer_deviation",
    """SELECT "user", date, peer_group, peer_z_events, peer_z_bytes_out, greatest(peer_z_events, peer_z_bytes_out) AS peer_zscore
       FROM net_peer""",
    "peer_z_events peer_z_bytes_out peer_zscore", "date",
)
def _(spark, sf):
    found = scores.with_peer_deviation(_scored(spark, sf), settings=SETTINGS)
    return found.select("user", "date", "peer_group", "peer_z_events", "peer_z_bytes_out", "peer_zscore")


@check(
    "e20_anomaly_types",
    """SELECT 'network' AS feed, "user", date, anomaly_types FROM net_kinds
       UNION ALL SELECT 'process', "user", date, anomaly_types FROM proc_kinds""",
    dates="date",
)
def _(spark, sf):
    """All five kinds, over the days of both feeds."""
    found = _detect(spark, sf)
    days = [
        network_kinds(found.scored_network, SETTINGS).select(F.lit("network").alias("feed"), "user", "date", "anomaly_types"),
        process_kinds(found.scored_process, found.peers, SETTINGS).select(F.lit("process").alias("feed"), "user", "date", "anomaly_types"),
    ]
    return days[0].unionByName(days[1])


@check(
    "e21_baseline_ratio",
    """
    SELECT "user", date, CASE WHEN baseline_avg_bytes_out <> 0 THEN daily_bytes_out / baseline_avg_bytes_out END
      AS bytes_ratio FROM net_joined
    """,
    "bytes_ratio", "date",
)
def _(spark, sf):
    return _scored(spark, sf).select(
        "user", "date", baseline_ratio("daily_bytes_out", "baseline_avg_bytes_out").alias("bytes_ratio")
    )


# --- F: models ---------------------------------------------------------------------------


@check("f1_assemble", "SELECT \"user\", norm_baseline_avg_events AS x0, norm_baseline_avg_bytes_out AS x1 FROM norm", "x0 x1")
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    cells = vector_to_array("features")
    return pr.assemble(pr.normalised(_baseline(spark, sf)), NORMS).select(
        "user", cells[0].alias("x0"), cells[1].alias("x1")
    )


# K-means numbers its groups arbitrarily, and a forest is random: what is compared is that each result follows from
# the fitted model, worked out another way.


def _peer_model(base: DataFrame) -> pr.PeerModel:
    """The fixed centres as a model, with the ranges that scale their features."""
    ranges = pr.feature_ranges(base, pr.TWO_FEATURES).first().asDict()
    return pr.PeerModel(_peers_of(base), CENTROIDS, 0, 0.0, pr.TWO_FEATURES, ranges)


def _fitted(spark, sf):
    base = sinks.materialise(_baseline(spark, sf), "baseline")
    return base, pr.peer_groups(base, SETTINGS)


@check("f2_peer_groups", 'SELECT "user", TRUE AS nearest FROM net_base')
def _(spark, sf):
    base, found = _fitted(spark, sf)
    placed = pr.place_users(base.select("user", *pr.TWO_FEATURES), found).withColumnRenamed("peer_group", "placed")
    return found.groups.join(placed, "user").select("user", (F.col("peer_group") == F.col("placed")).alias("nearest"))


@check(
    "f3_peer_groups_six_features",
    'SELECT "user", TRUE AS nearest FROM (SELECT "user" FROM net_base UNION SELECT "user" FROM proc_base) u',
)
def _(spark, sf):
    bounds = _bounds(spark, sf)
    base = sinks.materialise(_baseline(spark, sf, bounds), "baseline")
    runs = sinks.materialise(_process_baseline(spark, sf, bounds), "process-baseline")
    found = pr.peer_groups_standardized(base, runs, SETTINGS)
    users = base.join(runs, "user", "full_outer").select("user", *pr.SIX_FEATURES).na.fill(0)
    stats = users.agg(*[F.avg(c).alias(f"m_{c}") for c in pr.SIX_FEATURES], *[F.stddev(c).alias(f"s_{c}") for c in pr.SIX_FEATURES]).first()
    scaled = users.select("user", *[((F.col(c) - stats[f"m_{c}"]) / stats[f"s_{c}"]).alias(c) for c in pr.SIX_FEATURES])
    placed = pr.assign_peers(scaled, pr.SIX_FEATURES, found.centroids).select("user", F.col("peer_group").alias("placed"))
    return found.groups.join(placed, "user").select("user", (F.col("peer_group") == F.col("placed")).alias("nearest"))


@check("f4_cluster_metrics", "SELECT 5 AS k, TRUE AS summed_cost, TRUE AS few_iterations")
def _(spark, sf):
    base, found = _fitted(spark, sf)
    far = pr.assign_peers(pr.normalised(base), NORMS, found.centroids)
    cost = far.agg(F.sum(F.col("peer_distance") * F.col("peer_distance")).alias("c")).select("c").scalar()
    return pr.cluster_metrics(found, base).select(
        "k", (F.abs(F.col("cost") - cost) < 1e-6).alias("summed_cost"), F.col("iterations").between(1, 20).alias("few_iterations")
    )


@check("f5_assign_peers", 'SELECT "user", peer_group FROM peers')
def _(spark, sf):
    return _peers_of(_baseline(spark, sf))


def _standard_features(spark, sf):
    table_ = sinks.materialise(_features(spark, sf), "features")
    params = pr.scaler_stats(table_, schemas.MODEL_FEATURES).first().asDict()
    return pr.standardize(table_, schemas.MODEL_FEATURES, params)


STD_FEATURES = [f"std_{c}" for c in schemas.MODEL_FEATURES]


@check(
    "f6_fit_iforest",
    "SELECT CAST(t AS INTEGER) AS tree, CAST(n AS INTEGER) AS sample, TRUE AS whole FROM range(100) r(t), (SELECT least(256, count(*)) AS n FROM feats) f",
)
def _(spark, sf):
    """Each tree has its sample, one root, two children per inner node, and leaves that hold the sample."""
    nodes = iforest.fit_iforest(_standard_features(spark, sf), STD_FEATURES, SETTINGS)
    leaf = F.col("feature") < 0
    counted = nodes.groupBy(F.col("tree").cast("int").alias("tree")).agg(
        F.max("sample").cast("int").alias("sample"), F.count(F.lit(1)).alias("n"), F.count_if(leaf).alias("leaves"),
        F.count_distinct("node").alias("distinct"), F.max("node").alias("last"),
        F.bool_and(leaf | ((F.col("left") > F.col("node")) & (F.col("right") > F.col("node")))).alias("down"),
    )
    whole = (F.col("n") == 2 * F.col("leaves") - 1) & (F.col("n") == F.col("distinct")) & (F.col("last") == F.col("n") - 1) & F.col("down")
    return counted.select("tree", "sample", whole.alias("whole"))


@check("f7_score_iforest", 'SELECT "user", TRUE AS walked FROM feats')
def _(spark, sf):
    """Each score against a walk down the table of nodes, one join per step."""
    standard = sinks.materialise(_standard_features(spark, sf), "standard")
    nodes = sinks.materialise(iforest.fit_iforest(standard, STD_FEATURES, SETTINGS), "forest")
    scored = iforest.score_iforest(standard, STD_FEATURES, nodes, SETTINGS).select("user", "anomaly_score")
    trees = nodes.select("tree", F.col("node").alias("at"), "feature", "threshold", "left", "right", "path")
    each = F.explode(F.sequence(F.lit(0), F.lit(SETTINGS.trees - 1))).alias("tree")
    where = standard.select("user", F.array(*STD_FEATURES).alias("x"), each).withColumn("at", F.lit(0))
    for _ in range(8):
        goes = F.when(F.element_at("x", F.col("feature") + 1) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        step = where.join(F.broadcast(trees), ["tree", "at"])
        where = step.select("user", "x", "tree", F.when(F.col("feature") < 0, F.col("at")).otherwise(goes).cast("int").alias("at"))
    ends = where.join(F.broadcast(trees), ["tree", "at"]).groupBy("user").agg(F.avg("path").alias("mean"))
    n = nodes.agg(F.max("sample").cast("double").alias("n")).select("n").scalar()
    usual = 2 * (F.ln(n - 1) + F.lit(0.5772156649015329)) - 2 * (n - 1) / n
    return scored.join(ends, "user").select("user", (F.abs(F.col("anomaly_score") + F.pow(F.lit(2.0), -F.col("mean") / usual)) < 1e-9).alias("walked"))


@check(
    "f8_contamination",
    """
    SELECT least(0.1::DOUBLE, avg(CASE WHEN combined_risk_score >= 0.7::DOUBLE THEN 1 ELSE 0 END) * 2) AS contamination
    FROM risk
    """,
    "contamination",
)
def _(spark, sf):
    return model.contamination(_detect(spark, sf).risk, SETTINGS)


@check(
    "f9_flag_anomalies",
    """
    SELECT vec_id, anomaly_score, CASE WHEN anomaly_score < (SELECT quantile_cont(anomaly_score, 0.08) FROM vec)
      THEN 1 ELSE 0 END AS is_anomaly FROM vec
    """,
    "anomaly_score",
)
def _(spark, sf):
    scored = _vectors(spark, sf)
    return model.flag_anomalies(scored, model.threshold_at(scored, 0.08))


@check(
    "f10_model_risk",
    """
    SELECT vec_id, risk_score, CASE WHEN risk_score >= 0.85::DOUBLE THEN 'CRITICAL'
      WHEN risk_score >= 0.7::DOUBLE THEN 'HIGH' WHEN risk_score >= 0.5::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
    FROM (SELECT vec_id, 1 - (anomaly_score - lo) / (hi - lo) AS risk_score
          FROM vec, (SELECT min(anomaly_score) AS lo, max(anomaly_score) AS hi FROM vec) r) s
    """,
    "risk_score",
)
def _(spark, sf):
    scored = _vectors(spark, sf)
    return model.model_risk(scored, tuple(model.score_range(scored).first()), SETTINGS).select(
        "vec_id", "risk_score", "risk_level"
    )


# The model run is of the network alone.
TRAINED = '(SELECT "user" FROM net_base WHERE "user" IN (SELECT "user" FROM net_sc)) t'


@check("f11_score_batch", f'SELECT "user", TRUE AS flagged, TRUE AS scaled, TRUE AS level FROM {TRAINED}')
def _(spark, sf):
    """Flag, risk and level of each user follow from the score, the threshold and the range of the model."""
    trained = _train(spark, sf)
    m, score = trained.model, F.col("anomaly_score")
    risk = 1 - (score - m.score_min) / (m.score_max - m.score_min)
    low = (score < m.threshold).cast("int") if m.threshold is not None else F.lit(0)
    level = F.expr("CASE WHEN risk_score >= 0.85D THEN 'CRITICAL' WHEN risk_score >= 0.7D THEN 'HIGH' WHEN risk_score >= 0.5D THEN 'MEDIUM' ELSE 'LOW' END")
    return trained.scores.select(
        "user", (F.col("is_anomaly") == low).alias("flagged"), (F.abs(F.col("risk_score") - risk) < 1e-9).alias("scaled"),
        (F.col("risk_level") == level).alias("level"),
    )


@check("f12_feature_table", FEATURE_SQL, FEATURE_DOUBLES)
def _(spark, sf):
    return _features(spark, sf)


def _same(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """Per user, whether two results of the model are equal."""
    cells = [c for c in mine.columns if c != "user"]
    left = mine.select("user", F.struct(*cells).alias("_a"))
    right = theirs.select("user", F.struct(*cells).alias("_b"))
    return left.join(right, "user", "full_outer").select("user", F.coalesce(F.col("_a") == F.col("_b"), F.lit(False)).alias("same"))


@check("f13_saved_model", f'SELECT "user", TRUE AS same FROM {TRAINED}')
def _(spark, sf):
    """The second of two published versions, read back, scores as the model that was saved."""
    trained = _train(spark, sf)
    path = _scratch(spark, "model")
    model.save_model(replace(trained.model, score_min=-9.0), path, 1)
    model.save_model(trained.model, path, 2)
    return _same(model.score_batch(trained.features, model.load_model(spark, path), SETTINGS), trained.scores)


@check("f13_placed_peers", f'SELECT "user", TRUE AS same FROM {TRAINED}')
def _(spark, sf):
    """A batch without peer groups gets those of the saved centroids, and scores as with them."""
    trained = _train(spark, sf)
    path = _scratch(spark, "model")
    model.save_model(trained.model, path, 1)
    return _same(model.score_batch(trained.features.drop("peer_group"), model.load_model(spark, path, 1), SETTINGS), trained.scores)


@check(
    "f14_run_ledger",
    """
    SELECT run_id, 'param' AS kind, 'peer_groups' AS name, '5' AS value FROM (VALUES ('run-1'), ('run-2')) r(run_id)
    UNION ALL
    SELECT run_id, 'metric', name, CAST(value AS VARCHAR) FROM (VALUES ('run-1'), ('run-2')) r(run_id), (
      SELECT unnest(['total_anomalies', 'critical_anomalies', 'high_anomalies']) AS name,
             unnest([count(*) FILTER (WHERE network_anomaly_score >= 0.5::DOUBLE),
                     count(*) FILTER (WHERE network_anomaly_score >= 0.85::DOUBLE),
                     count(*) FILTER (WHERE network_anomaly_score >= 0.7::DOUBLE AND network_anomaly_score < 0.85::DOUBLE)]) AS value
      FROM net_sc) m
    """,
)
def _(spark, sf):
    """Metrics observed while the scored days are written; a repeated run replaces its rows."""
    path, counted = _scratch(spark, "ledger"), Observation()
    score = F.col("network_anomaly_score")
    seen = _scored(spark, sf).observe(
        counted, F.count_if(score >= 0.5).alias("total_anomalies"), F.count_if(score >= 0.85).alias("critical_anomalies"),
        F.count_if((score >= 0.7) & (score < 0.85)).alias("high_anomalies"),
    )
    sinks.materialise(seen, "observed")
    for run in ("run-1", "run-2", "run-1"):
        model.append_ledger(spark, path, run, {"peer_groups": SETTINGS.peer_groups}, counted.get)
    return model.read_ledger(spark, path)


@check(
    "f14_run_metrics",
    """
    SELECT 'run-1' AS run_id, 'param' AS kind, 'peer_groups' AS name, '5' AS value
    UNION ALL
    SELECT 'run-1', 'metric', name, CAST(value AS VARCHAR) FROM (
      SELECT unnest(['total_anomalies', 'critical_anomalies', 'high_anomalies']) AS name,
             unnest([count(*) FILTER (WHERE network_anomaly_score >= 0.5::DOUBLE),
                     count(*) FILTER (WHERE network_anomaly_score >= 0.85::DOUBLE),
                     count(*) FILTER (WHERE network_anomaly_score >= 0.7::DOUBLE
                                        AND network_anomaly_score < 0.85::DOUBLE)]) AS value
      FROM net_sc) m
    """,
)
def _(spark, sf):
    stats = rk.anomaly_stats(_scored(spark, sf), settings=SETTINGS)
    return model.run_metrics(spark, "run-1", {"peer_groups": SETTINGS.peer_groups}, stats)


@check(
    "f15_evaluate",
    """
    SELECT tp, fp, fn, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) END AS precision,
           CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) END AS recall
    FROM (
      SELECT count(*) FILTER (WHERE f AND r) AS tp, count(*) FILTER (WHERE f AND NOT r) AS fp,
             count(*) FILTER (WHERE NOT f AND r) AS fn
      FROM (SELECT network_anomaly_score >= 0.5::DOUBLE AS f, coalesce(l.n, 0) > 0 AS r
            FROM net_sc s LEFT JOIN (SELECT "user", date, count(*) FILTER (WHERE is_anomaly) AS n FROM net_both
                                     WHERE period = 'analysis' GROUP BY 1, 2) l
              ON l."user" = s."user" AND l.date = s.date) x
    ) y
    """,
    "precision recall",
)
def _(spark, sf):
    labels = features.labelled_counts(bd.in_analysis(network(spark, sf), _bounds(spark, sf), SETTINGS))
    return model.evaluate(_scored(spark, sf), labels, settings=SETTINGS)


@check(
    "f15_curve",
    """
    WITH x AS (SELECT network_anomaly_score AS threshold, coalesce(l.n, 0) > 0 AS r
               FROM net_sc s LEFT JOIN (SELECT "user", date, count(*) FILTER (WHERE is_anomaly) AS n FROM net_both
                                        WHERE period = 'analysis' GROUP BY 1, 2) l
                 ON l."user" = s."user" AND l.date = s.date),
    c AS (SELECT threshold, count(*) AS n, count(*) FILTER (WHERE r) AS h FROM x GROUP BY 1),
    t AS (SELECT threshold, CAST(sum(n) OVER w AS BIGINT) AS flagged, CAST(sum(h) OVER w AS BIGINT) AS tp, (SELECT sum(h) FROM c) AS a
          FROM c WINDOW w AS (ORDER BY threshold DESC))
    SELECT threshold, flagged, tp, flagged - tp AS fp, CAST(a - tp AS BIGINT) AS fn, tp::DOUBLE / flagged AS precision,
           CASE WHEN a > 0 THEN tp::DOUBLE / a END AS recall FROM t
    """,
    "threshold precision recall",
)
def _(spark, sf):
    labels = features.labelled_counts(bd.in_analysis(network(spark, sf), _bounds(spark, sf), SETTINGS))
    return model.threshold_curve(_scored(spark, sf), labels, settings=SETTINGS)


# --- G: findings -------------------------------------------------------------------------

CONTEXT_SQL = """
    strftime(analysis_start, '%Y-%m-%d %H:%M:%S.%f') AS analysis_period_start,
    strftime(analysis_end, '%Y-%m-%d %H:%M:%S.%f') AS analysis_period_end,
    strftime(baseline_start, '%Y-%m-%d %H:%M:%S.%f') AS baseline_period_start,
    strftime(analysis_start, '%Y-%m-%d %H:%M:%S.%f') AS baseline_period_end
"""
CONTEXT_COLUMNS = "analysis_period_start analysis_period_end baseline_period_start baseline_period_end".split()


def _open_context(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if not c.endswith("_evidence") and c != "context"]
    evidence = next(c for c in df.columns if c.endswith("_evidence"))
    opened = df.select(*rest, f"{evidence}.*", "context.*")
    return opened.withColumns({c: F.col(c).cast("timestamp_ntz") for c in CONTEXT_COLUMNS})


@check(
    "g1_network_findings", f"SELECT net_find.*, {CONTEXT_SQL} FROM net_find, b",
    "risk_score baseline_avg_events events_zscore bytes_out_zscore", times="event_time",
)
def _(spark, sf):
    d = _detect(spark, sf)
    return _open_context(fd.network_findings(network_kinds(d.scored_network, SETTINGS), d.risk, d.bounds, SETTINGS))


@check(
    "g2_process_findings", f"SELECT proc_find.*, {CONTEXT_SQL} FROM proc_find, b",
    "risk_score baseline_avg_processes", times="event_time",
)
def _(spark, sf):
    d = _detect(spark, sf)
    kinds = process_kinds(d.scored_process, d.peers, SETTINGS)
    return _open_context(fd.process_findings(kinds, d.risk, d.bounds, SETTINGS))


MODEL_FINDINGS_SQL = """
    SELECT sha256('ueba_network_anomaly_detection_mlflow|' || "user" || '|' || CAST(CAST(event_time AS DATE) AS VARCHAR)) AS finding_id,
           event_time, "user", finding_type, severity, 'Anomalous Network Behavior - ' || "user" AS title,
           'User ' || "user" || ' (Peer Group ' || CAST(peer_group AS VARCHAR)
             || ') exhibited unusual network activity' AS description,
           risk_score, risk_level, 'ueba_network_anomaly_detection_mlflow' AS analytic_name, analytic_type,
           recommended_actions, 'run-1' AS model_version
    FROM net_find"""


def _model_findings(spark, sf, limit):
    d = _detect(spark, sf)
    found = fd.network_findings(d.scored_network, d.risk, d.bounds, SETTINGS, limit, "run-1")
    return found.drop("peer_group", "network_evidence", "context", "anomaly_types")


@check(
    "g3_model_findings",
    MODEL_FINDINGS_SQL,
    "risk_score", times="event_time",
)
def _(spark, sf):
    return _model_findings(spark, sf, None)


@check(
    "i7_top_model_findings", MODEL_FINDINGS_SQL + ' ORDER BY risk_score DESC, "user", event_time LIMIT 100',
    "risk_score", times="event_time",
)
def _(spark, sf):
    return _model_findings(spark, sf, 100)


@check("g4_recommended_actions", "SELECT finding_id, recommended_actions FROM find")
def _(spark, sf):
    return _detect(spark, sf).findings.select("finding_id", "recommended_actions")


@check("g5_finding_id", 'SELECT finding_id, finding_type, "user" FROM find')
def _(spark, sf):
    return _detect(spark, sf).findings.select("finding_id", "finding_type", "user")


@check("g6_midnight", "SELECT finding_id, event_time FROM find", times="event_time")
def _(spark, sf):
    return _detect(spark, sf).findings.select("finding_id", "event_time")


@check(
    "g7_load_meta",
    """
    SELECT finding_id, TIMESTAMP '2024-02-01 06:00:00' AS load_timestamp, '1.0' AS analysis_version FROM find
    """,
    times="load_timestamp",
)
def _(spark, sf):
    return fd.with_load_meta(_detect(spark, sf).findings, at="2024-02-01 06:00:00").select(
        "finding_id", "load_timestamp", "analysis_version"
    )


@check("g8_rule_network", "SELECT * FROM rule_net", "risk_score", times="event_time")
def _(spark, sf):
    return rules.rule_network(_reasoned(spark, sf))


@check("g9_rule_process", "SELECT * FROM rule_proc", "risk_score", times="event_time")
def _(spark, sf):
    return rules.rule_process(process(spark, sf))


NUMBERED_SQL = """
    SELECT row_number() OVER (ORDER BY finding_type, event_id) AS finding_id, event_time, "user", finding_type,
           severity, title, risk_score
    FROM (SELECT event_id, event_time, "user", finding_type, severity, title, risk_score FROM rule_net
          UNION ALL SELECT event_id, event_time, "user", finding_type, severity, title, risk_score FROM rule_proc) r
"""


@check("g10_numbered_rule_findings", NUMBERED_SQL, "risk_score", times="event_time")
def _(spark, sf):
    return rules.rule_findings(_reasoned(spark, sf), process(spark, sf)).select(
        "finding_id", "event_time", "user", "finding_type", "severity", "title", "risk_score"
    )


@check(
    "g11_ticket_queue",
    """
    SELECT finding_id, title, description, 'P1' AS priority, 'Security Operations' AS assignment_group
    FROM find WHERE severity = 'CRITICAL'
    """,
)
def _(spark, sf):
    return fd.ticket_queue(_detect(spark, sf).findings)


# --- I: sorted reports -------------------------------------------------------------------

TOP_NET = (
    '"user", date, peer_group, daily_events, baseline_avg_events, events_zscore, daily_bytes_out,'
    " baseline_avg_bytes_out, bytes_out_zscore, network_anomaly_score, network_anomaly_level"
)


@check(
    "i1_top_network",
    f"""
    SELECT {TOP_NET} FROM net_sc WHERE network_anomaly_score >= 0.5::DOUBLE
    ORDER BY network_anomaly_score DESC, "user", date LIMIT 20
    """,
    "baseline_avg_events events_zscore baseline_avg_bytes_out bytes_out_zscore network_anomaly_score", "date",
)
def _(spark, sf):
    return scores.top_network(_scored(spark, sf), 20, SETTINGS)


@check(
    "i2_top_process",
    """
    SELECT "user", date, daily_processes, baseline_avg_processes, processes_zscore, suspicious_process_count,
           process_anomaly_score, process_anomaly_level
    FROM proc_sc WHERE process_anomaly_score >= 0.5::DOUBLE
    ORDER BY process_anomaly_score DESC, "user", date LIMIT 20
    """,
    "baseline_avg_processes processes_zscore process_anomaly_score", "date",
)
def _(spark, sf):
    return scores.top_process(_process_scored(spark, sf), 20, SETTINGS)


@check(
    "i3_top_users",
    """
    SELECT "user", combined_risk_score, final_risk_level FROM risk WHERE combined_risk_score >= 0.7::DOUBLE
    ORDER BY combined_risk_score DESC, "user" LIMIT 5
    """,
    "combined_risk_score",
)
def _(spark, sf):
    return rk.top_users(_detect(spark, sf).risk, 5, SETTINGS)


@check(
    "i4_top_days_per_user",
    """
    SELECT "user", date, network_anomaly_score,
           CAST(row_number() OVER (PARTITION BY "user" ORDER BY network_anomaly_score DESC, date) AS INTEGER) AS day_rank
    FROM net_sc QUALIFY day_rank <= 3
    """,
    "network_anomaly_score", "date",
)
def _(spark, sf):
    return scores.top_days_per_user(_scored(spark, sf), 3).select("user", "date", "network_anomaly_score", "day_rank")


# --- J: set operations -------------------------------------------------------------------


@check("j1_all_findings", "SELECT * FROM find", "risk_score", times="event_time")
def _(spark, sf):
    return _detect(spark, sf).findings.select(*FINDING_COLUMNS)


@check("j2_distinct_values", "SELECT DISTINCT dest_ip FROM net")
def _(spark, sf):
    return reports.distinct_values(network(spark, sf), "dest_ip")


# --- L: sinks (written to the shared folder, then read back) -------------------------------

BASELINE_DOUBLES = BASE_DOUBLES + " baseline_avg_hosts baseline_std_hosts baseline_avg_active_hours"


@check("l1_write_table", f'SELECT event_id, {NET_FLAT} FROM net', times="event_time")
def _(spark, sf):
    path = _scratch(spark, "table")
    sinks.write_table(network(spark, sf).select("event_id", *NET_COLUMNS), path)
    return spark.read.parquet(path)


@check("l2_append_findings", "SELECT * FROM find", "risk_score", times="event_time")
def _(spark, sf):
    path = _scratch(spark, "findings")
    found = _detect(spark, sf).findings.select(*FINDING_COLUMNS)
    sinks.append_findings(found.filter(F.col("finding_type") == "network_anomaly"), path)
    # Everything again: only the process findings are new.
    return sinks.append_findings(found, path)


# The analysis as it would have been six hours earlier.
EARLIER = PRELUDE.replace("FROM events", "FROM (SELECT * FROM events WHERE ts < (SELECT max(ts) FROM events) - INTERVAL 6 HOURS)")
# What the first run found on days that the second run saw less of, or not at all.
EARLIER_FIND = f"(SELECT * FROM ({EARLIER} SELECT * FROM find) e WHERE event_time <= (SELECT date_trunc('day', analysis_start) FROM b))"


def _two_runs(spark, sf, again: bool = False) -> DataFrame:
    """The findings of a run without the last six hours, then those of the whole run; ``again`` repeats both."""
    path = _scratch(spark, "raised")
    whole = _detect(spark, sf)
    before = F.lit(whole.bounds.analysis_end) - F.expr("INTERVAL 6 HOURS")
    part = detect(network(spark, sf).filter(F.col("event_time") < before), process(spark, sf).filter(F.col("event_time") < before), SETTINGS, _peers_of)
    runs = [(sinks.materialise(r.findings, "found"), covered_by(r)) for r in (part, whole)]
    for findings, covered in runs * (2 if again else 1):
        stored = sinks.append_findings(findings, path, covered)
    return stored


@check(
    "l2_append_raised",
    f"SELECT * FROM find WHERE finding_id NOT IN (SELECT finding_id FROM {EARLIER_FIND}) UNION ALL SELECT * FROM {EARLIER_FIND}",
    "risk_score", times="event_time",
)
def _(spark, sf):
    # Every day of both windows; the repeated runs change nothing.
    return sinks.current_findings(_two_runs(spark, sf, again=True)).select(*FINDING_COLUMNS)


@check(
    "l2_withdrawn_findings",
    f"""SELECT finding_id, event_time, "user", severity, risk_score FROM ({EARLIER} SELECT * FROM find) e
        WHERE finding_id NOT IN (SELECT finding_id FROM find) AND event_time > (SELECT date_trunc('day', analysis_start) FROM b)""",
    "risk_score", times="event_time",
)
def _(spark, sf):
    history = sinks.finding_history(_two_runs(spark, sf)).filter("change = 'withdrawn' AND step = 2")
    return history.select("finding_id", "event_time", "user", "severity", "risk_score")


@check("l3_export_json", 'SELECT finding_id, "user", severity, risk_score FROM find', "risk_score")
def _(spark, sf):
    path = _scratch(spark, "json")
    sinks.export_json(_detect(spark, sf).findings, path)
    return spark.read.schema("finding_id string, user string, severity string, risk_score double").json(path)


@check(
    "l4_export_cef",
    """
    SELECT 'CEF:0|veerline|anomaly|1.0|' || finding_type || '|' || title || '|'
             || CASE severity WHEN 'CRITICAL' THEN '10' WHEN 'HIGH' THEN '8' WHEN 'MEDIUM' THEN '5' ELSE '3' END
             || '|externalId=' || finding_id || ' suser=' || "user"
             || ' rt=' || CAST(epoch_ms(event_time) AS VARCHAR)
             || ' cn1Label=risk_score cn1=' || printf('%.6f', risk_score) || ' msg=' || description AS value
    FROM find
    """,
)
def _(spark, sf):
    path = _scratch(spark, "cef")
    sinks.export_cef(_detect(spark, sf).findings, path)
    return spark.read.text(path)


@check(
    "l5_write_events",
    'SELECT CAST(event_time AS DATE) AS date, "user", event_id, bytes_out FROM net', dates="date",
)
def _(spark, sf):
    path = _scratch(spark, "events")
    sinks.write_events(network(spark, sf), path)
    return spark.read.parquet(path).select("date", "user", "event_id", "bytes_out")


@check(
    "l5_write_events_daily",
    'SELECT CAST(event_time AS DATE) AS date, "user", event_id, bytes_out FROM net', dates="date",
)
def _(spark, sf):
    """Two loads, the second with a day that the first had in part: both are kept, the day once."""
    path = _scratch(spark, "events-daily")
    events = network(spark, sf)
    for part in ("event_time < TIMESTAMP_NTZ '2024-01-15 12:00:00'", "event_time >= TIMESTAMP_NTZ '2024-01-15 00:00:00'"):
        sinks.write_events(events.filter(part), path, replace="days")
    return spark.read.parquet(path).select("date", "user", "event_id", "bytes_out")


def _refreshed(spark, sf) -> str:
    """The store of user-days after two runs, the first of which ended in the middle of a day."""
    path = _scratch(spark, "days")
    events = network(spark, sf)
    refresh_days(events.filter("event_time < TIMESTAMP_NTZ '2024-01-20 12:00:00'"), path, SETTINGS.with_(analysis_days=12))
    computed = refresh_days(events, path, SETTINGS)
    assert min(computed).isoformat() == "2024-01-20"
    return path


WHOLE_DAYS_SQL = """
    SELECT "user", CAST(event_time AS DATE) AS date, count(*) AS daily_events,
           CAST(sum(bytes_out) AS BIGINT) AS daily_bytes_out, count(DISTINCT dest_ip) AS unique_destinations,
           count(DISTINCT dest_host) AS unique_hosts, count(DISTINCT hour(event_time)) AS active_hours,
           min(hour(event_time)) AS first_activity_hour, max(hour(event_time)) AS last_activity_hour
    FROM net GROUP BY 1, 2"""


@check(
    "l7_merged_baseline",
    f"""SELECT "user", avg(daily_events) AS baseline_avg_events, stddev_samp(daily_events) AS baseline_std_events,
         max(daily_events) AS baseline_max_events,
         avg(daily_bytes_out) AS baseline_avg_bytes_out, stddev_samp(daily_bytes_out) AS baseline_std_bytes_out,
         max(daily_bytes_out) AS baseline_max_bytes_out,
         avg(unique_destinations) AS baseline_avg_destinations, stddev_samp(unique_destinations) AS baseline_std_destinations,
         avg(unique_hosts) AS baseline_avg_hosts, stddev_samp(unique_hosts) AS baseline_std_hosts,
         avg(active_hours) AS baseline_avg_active_hours, avg(first_activity_hour) AS baseline_typical_start_hour,
         avg(last_activity_hour) AS baseline_typical_end_hour, count(*) AS baseline_active_days
        FROM ({WHOLE_DAYS_SQL}) d, b WHERE date >= CAST(baseline_start AS DATE) AND date < CAST(analysis_start AS DATE)
        GROUP BY "user" """,
    BASELINE_DOUBLES,
)
def _(spark, sf):
    """The baseline of whole days, from user-days that two runs have stored."""
    bounds = bd.resolve_bounds(network(spark, sf), SETTINGS)
    days = [date.fromisoformat(getattr(bounds, n)[:10]) for n in ("baseline_start", "analysis_start")]
    return baseline_of_days(stored_days(spark, _refreshed(spark, sf)), *days)


ROLLED = ["events", "bytes_out", "destinations", "hosts"]


@check(
    "e18_rolling_scores",
    f"""
    WITH d AS (SELECT x.*, date_diff('day', DATE '2024-01-01', date) AS day_no FROM ({WHOLE_DAYS_SQL}) x, b
               WHERE date >= CAST(baseline_start AS DATE)),
    r AS (SELECT d.*, avg(daily_events) OVER w AS ae, stddev_samp(daily_events) OVER w AS se,
                 avg(daily_bytes_out) OVER w AS ab, stddev_samp(daily_bytes_out) OVER w AS sb,
                 avg(unique_destinations) OVER w AS ad, stddev_samp(unique_destinations) OVER w AS sd,
                 avg(unique_hosts) OVER w AS ah, stddev_samp(unique_hosts) OVER w AS sh,
                 avg(first_activity_hour) OVER w AS fh, avg(last_activity_hour) OVER w AS lh
          FROM d WINDOW w AS (PARTITION BY "user" ORDER BY day_no RANGE BETWEEN 21 PRECEDING AND 1 PRECEDING)),
    z AS (SELECT *, coalesce(CASE WHEN se > 0 THEN abs(daily_events - ae) / se END, 0) AS ze,
                 coalesce(CASE WHEN sb > 0 THEN abs(daily_bytes_out - ab) / sb END, 0) AS zb,
                 coalesce(CASE WHEN sd > 0 THEN abs(unique_destinations - ad) / sd END, 0) AS zd,
                 coalesce(CASE WHEN sh > 0 THEN abs(unique_hosts - ah) / sh END, 0) AS zh,
                 CASE WHEN first_activity_hour < fh - 2 OR last_activity_hour > lh + 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS ho FROM r)
    SELECT "user", date, least(ze / 3.0::DOUBLE, 1.0::DOUBLE) * 0.2::DOUBLE + least(zb / 3.0::DOUBLE, 1.0::DOUBLE) * 0.4::DOUBLE
           + least(zd / 3.0::DOUBLE, 1.0::DOUBLE) * 0.2::DOUBLE + least(zh / 3.0::DOUBLE, 1.0::DOUBLE) * 0.1::DOUBLE
           + ho * 0.1::DOUBLE AS network_anomaly_score FROM z, b WHERE date >= CAST(analysis_start AS DATE)
    """,
    "network_anomaly_score", "date",
)
def _(spark, sf):
    start = date.fromisoformat(bd.resolve_bounds(network(spark, sf), SETTINGS).analysis_start[:10])
    scored = rolling_scores(stored_days(spark, _refreshed(spark, sf)), SETTINGS, start)
    return scored.select("user", "date", "network_anomaly_score")


@check("l7_saved_baseline", "SELECT * FROM net_base", BASELINE_DOUBLES)
def _(spark, sf):
    path = _scratch(spark, "baseline")
    sinks.save_baseline(_baseline(spark, sf), path)
    return sinks.load_baseline(spark, path)


# --- M: streams --------------------------------------------------------------------------


def _event_stream(spark, sf) -> DataFrame:
    """The event table as a stream of network events (from a copy in a folder of its own)."""
    path = _scratch(spark, "stream-in")
    events = network(spark, sf).withColumn("event_time", F.col("event_time").cast("timestamp"))
    events.write.parquet(path)
    return read_event_stream(spark, path, events.schema)


@check("m1_score_stream", f'SELECT "user", TRUE AS same FROM {TRAINED}')
def _(spark, sf):
    trained = _train(spark, sf)
    inputs, out, state = (_scratch(spark, x) for x in ("rows-in", "rows-out", "rows-state"))
    trained.features.select("user", *schemas.MODEL_FEATURES).write.parquet(inputs)
    stream = read_event_stream(spark, inputs, spark.read.parquet(inputs).schema)
    query = (
        score_stream(stream, trained.model, SETTINGS)
        .writeStream.format("parquet")
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return _same(spark.read.schema(schemas.MODEL_OUTPUT).parquet(out), trained.scores)


STREAM_SQL = """
    SELECT "user", CAST(event_time AS DATE) AS date, count(*) AS daily_events,
           CAST(sum(bytes_out) AS BIGINT) AS daily_bytes_out, CAST(sum(bytes_in) AS BIGINT) AS daily_bytes_in,
           count(DISTINCT dest_ip) AS unique_destinations, count(DISTINCT dest_host) AS unique_hosts,
           count(DISTINCT hour(event_time)) AS active_hours,
           CAST(min(hour(event_time)) AS INTEGER) AS first_activity_hour,
           CAST(max(hour(event_time)) AS INTEGER) AS last_activity_hour
    FROM net GROUP BY 1, 2"""
CLOSED_SQL = "CAST(date AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT max(event_time) - INTERVAL 1 HOUR FROM net)"


@check("m2_stream_daily", f"SELECT * FROM ({STREAM_SQL}) d WHERE {CLOSED_SQL}", dates="date")
def _(spark, sf):
    out, state = _scratch(spark, "daily-out"), _scratch(spark, "daily-state")
    daily = stream_daily(_event_stream(spark, sf))
    schema = daily.schema
    query = (
        daily.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(out)


ALERT_SQL = """
    SELECT sha256('network_anomaly|' || "user" || '|' || CAST(date AS VARCHAR)) AS finding_id, "user", date,
           network_anomaly_score, network_anomaly_level
    FROM net_sc, b WHERE network_anomaly_score >= 0.7::DOUBLE AND date > CAST(analysis_start AS DATE)"""
ALERTS = "finding_id string, user string, date date, network_anomaly_score double, network_anomaly_level string"


@check("m3_alert_stream", f"{ALERT_SQL} AND {CLOSED_SQL}", "network_anomaly_score", "date")
def _(spark, sf):
    """Whole days of the analysis that are closed, against the newest stored baseline."""
    out, state, base = (_scratch(spark, x) for x in ("alerts-out", "alerts-state", "alerts-base"))
    current = sinks.materialise(_baseline(spark, sf), "baseline")
    # An old version with other numbers, which no batch may take.
    sinks.save_baseline(current.withColumn("baseline_avg_events", F.lit(0.0)), base, 1)
    sinks.save_baseline(current, base, 2)
    daily = stream_daily(_event_stream(spark, sf)).filter(F.col("date") > F.lit(_bounds(spark, sf).analysis_start).cast("date"))
    alert_stream(daily, base, out, state, SETTINGS).awaitTermination()
    return spark.read.option("recursiveFileLookup", True).schema(ALERTS).parquet(out)


@check("m3_revised_alerts", ALERT_SQL, "network_anomaly_score", "date")
def _(spark, sf):
    """Events of three batches, the last of them days late: alerts are raised and corrected until they are right."""
    source, out, state = (_scratch(spark, x) for x in ("revised-in", "revised-out", "revised-state"))
    base = sinks.materialise(_baseline(spark, sf), "baseline")
    start = F.lit(_bounds(spark, sf).analysis_start).cast("date")
    events = network(spark, sf).withColumn("event_time", F.col("event_time").cast("timestamp")).filter(F.to_date("event_time") > start)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        for batch in range(3):
            events.filter(F.col("event_id") % 3 == batch).write.mode("append").parquet(source)
            daily = revised_daily(read_event_stream(spark, source, events.schema), timedelta(days=10))
            alert_stream(daily, base, out, state, SETTINGS).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    return current_alerts(spark, out, SETTINGS)


# --- O: reports --------------------------------------------------------------------------


@check(
    "o1_analysis_summary",
    f"""
    SELECT 'period' AS section, n AS item, epoch(v)::BIGINT::DOUBLE AS value FROM (
      SELECT unnest(['baseline_start', 'analysis_start', 'analysis_end']) AS n,
             unnest([date_trunc('second', baseline_start)::TIMESTAMP, date_trunc('second', analysis_start)::TIMESTAMP,
                     date_trunc('second', analysis_end)::TIMESTAMP]) AS v FROM b) t
    UNION ALL SELECT 'data', 'network_events', count(*) FROM net_both WHERE period = 'analysis'
    UNION ALL SELECT 'data', 'process_events', count(*) FROM proc_both WHERE period = 'analysis'
    UNION ALL SELECT 'data', 'users', count(*) FROM risk
    UNION ALL SELECT 'risk', final_risk_level, count(*) FROM risk GROUP BY final_risk_level
    UNION ALL SELECT 'findings', severity, findings FROM ({SEVERITY_SQL}) s
    UNION ALL SELECT 'top_users', "user", combined_risk_score FROM (
      SELECT * FROM risk WHERE combined_risk_score >= 0.7::DOUBLE ORDER BY combined_risk_score DESC, "user" LIMIT 5) u
    """,
    "value",
)
def _(spark, sf):
    d = _detect(spark, sf)
    return reports.analysis_summary(d.scored_network, d.scored_process, d.risk, d.findings, d.bounds, SETTINGS)


def _profile_rows(section: str, subject: str, source: str) -> str:
    return f"""
      SELECT '{section}' AS section, unnest(['events', 'anomalous_events', 'anomalous_percent', 'unique_users',
                                             'unique_{subject}']) AS item,
             unnest([events::DOUBLE, anomalous_events::DOUBLE, anomalous_percent, unique_users::DOUBLE,
                     unique_{subject}::DOUBLE]) AS value
      FROM ({PROFILE_SQL.format(subject, source)}) p
    """


@check(
    "o2_quality_summary",
    f"""
    {_profile_rows('network', 'dest_host', 'net')}
    UNION ALL {_profile_rows('process', 'process_name', 'proc')}
    UNION ALL SELECT 'findings', 'findings', count(*)::DOUBLE FROM find
    UNION ALL SELECT 'findings', 'unique_users', count(DISTINCT "user")::DOUBLE FROM find
    UNION ALL SELECT 'findings_by_type', finding_type, count(*)::DOUBLE FROM find GROUP BY finding_type
    """,
    "value",
)
def _(spark, sf):
    return reports.quality_summary(network(spark, sf), process(spark, sf), _detect(spark, sf).findings)


@check(
    "o3_investigation",
    f"""
    SELECT 'risk' AS section, final_risk_level AS item, combined_risk_score AS value FROM risk WHERE "user" = '{USER}'
    UNION ALL SELECT * FROM (
      SELECT 'top_days', CAST(date AS VARCHAR), network_anomaly_score FROM net_sc WHERE "user" = '{USER}'
      ORDER BY network_anomaly_score DESC, date LIMIT 3) t
    UNION ALL SELECT 'bytes_out_by_host', dest_host, sum(bytes_out)::DOUBLE FROM net
      WHERE "user" = '{USER}' AND event_time >= TIMESTAMP '{SINCE} 00:00:00' GROUP BY dest_host
    UNION ALL SELECT 'process_runs', process_name, count(*)::DOUBLE FROM procx
      WHERE "user" = '{USER}' AND event_time >= TIMESTAMP '{SINCE} 00:00:00' GROUP BY process_name
    """,
    "value",
)
def _(spark, sf):
    d = _detect(spark, sf)
    found = reports.investigation(
        USER, SINCE, d.risk, d.scored_network, network(spark, sf), process(spark, sf)
    )
    return reports.investigation_summary(found)
