from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from veerline.config import DEFAULT
from veerline.functions import cef_line
from veerline.operators import findings as fd, rules
from veerline.plans import detect
from veerline.sinks import (
    Covered,
    append_findings,
    append_to_table,
    current_findings,
    export_cef,
    export_json,
    finding_history,
    write_events,
)
from veerline.sources import create_tables, describe, read_findings, read_optional

from .rows import END, frame, network_row, process_row, processes, steady


def loud_user(spark, group=0):
    rows = steady("ann", 15, lambda i: 2 + i % 3)
    rows += [network_row(END - timedelta(minutes=m), bytes_out=10**6, dest_ip=f"203.0.113.{m}") for m in range(60)]
    peers = spark.createDataFrame([("ann", group)], "user string, peer_group int")
    return detect(frame(spark, rows), None, DEFAULT, peers)


def test_peer_group_zero_is_kept(spark):
    row = loud_user(spark).findings.first()
    assert row["peer_group"] == 0
    assert "(Peer Group 0)" in row["description"]


def test_missing_peer_group_is_minus_one(spark):
    found = loud_user(spark, None)
    assert found.findings.first()["peer_group"] == -1


def test_actions_follow_the_transfer(spark):
    row = loud_user(spark).findings.first()
    assert row["recommended_actions"][2] == fd.CHECK_EXFILTRATION
    assert row["network_evidence"]["daily_events"] == 60
    assert row["context"]["analysis_period_end"].startswith("2024-03-31 12:00:00")


def test_append_is_repeatable_and_grows_columns(spark, tmp_path):
    found = loud_user(spark).findings.drop("network_evidence", "context")
    path = str(tmp_path / "findings")
    assert append_findings(found, path).count() == 1
    assert append_findings(found, path).count() == 1
    other = found.withColumn("finding_id", F.lit("other")).withColumn("model_version", F.lit("v1"))
    stored = append_findings(other, path)
    assert stored.count() == 2
    assert "model_version" in stored.columns


def test_raised_finding_replaces_that_of_a_cut_day(spark, tmp_path):
    whole = loud_user(spark).findings
    part = whole.withColumns({
        "severity": F.lit("MEDIUM"), "risk_score": F.lit(0.5),
        "network_evidence": F.col("network_evidence").withField("daily_events", F.lit(5).cast("bigint")),
    })
    want = [(r["severity"], r["risk_score"]) for r in whole.collect()]
    for first, second in ((part, whole), (whole, part)):
        path = str(tmp_path / f"raised-{first is part}")
        append_findings(first, path)
        assert append_findings(second, path).count() == 2
        assert append_findings(first, path).count() == 2
        found = current_findings(append_findings(second, path))
        assert [(r["severity"], r["risk_score"]) for r in found.collect()] == want
        assert found.columns == append_findings(second, path).columns
    spark.sql("DROP DATABASE IF EXISTS raised CASCADE")
    name = create_tables(spark, "raised")[2]
    for found in (part, whole, part, whole):
        append_to_table(fd.with_load_meta(found), name)
    assert spark.table(name).count() == 2
    assert [(r["SEVERITY"], r["RISK_SCORE"]) for r in current_findings(spark.table(name)).collect()] == want


def test_findings_are_withdrawn_and_come_back(spark, tmp_path):
    run = loud_user(spark)
    found, none = run.findings, run.findings.limit(0)

    def at(days):
        """The same run, some days later: its window still covers the whole day of the finding."""
        moved = {n: str(datetime.fromisoformat(getattr(run.bounds, n)) + timedelta(days=days)) for n in ("analysis_start", "analysis_end")}
        return Covered(replace(run.bounds, **moved), (fd.NETWORK_ANALYTIC,))

    def seen(covered):
        end = F.lit(covered.bounds.analysis_end)
        start = F.lit(covered.bounds.analysis_start)
        return found.withColumn("context", F.col("context").withField("analysis_period_start", start).withField("analysis_period_end", end))

    path = str(tmp_path / "store")
    spark.sql("DROP DATABASE IF EXISTS withdrawn CASCADE")
    name = create_tables(spark, "withdrawn")[2]
    steps = [(found, at(0), 1, 1), (none, at(1), 2, 0), (none, at(2), 2, 0), (found, at(0), 2, 0), (seen(at(3)), at(3), 3, 1), (seen(at(3)), at(3), 3, 1)]
    for rows, covered, stored, current in steps:
        table = append_findings(rows, path, covered)
        append_to_table(rows, name, covered)
        for kept in (table, spark.table(name)):
            assert (kept.count(), current_findings(kept).count()) == (stored, current)
    history = finding_history(table).orderBy("step").collect()
    assert [x.change for x in history] == ["raised", "withdrawn", "again"]
    # Another analytic, and a run that saw less of the day, withdraw nothing.
    other = Covered(at(4).bounds, (fd.PROCESS_ANALYTIC,))
    less = Covered(replace(at(4).bounds, analysis_start=str(END + timedelta(hours=1))), (fd.NETWORK_ANALYTIC,))
    for covered in (other, less):
        assert current_findings(append_findings(none, path, covered)).count() == 1


def test_append_to_ocsf_table(spark):
    spark.sql("DROP DATABASE IF EXISTS appended CASCADE")
    names = create_tables(spark, "appended")
    assert [len(spark.table(n).columns) for n in names] == [70, 68, 60]
    assert any(r["col_name"] == "TRAFFIC" and r["comment"] == "JSON object" for r in describe(spark, names[0]).collect())
    found = fd.with_load_meta(loud_user(spark).findings)
    append_to_table(found, names[2])
    append_to_table(found, names[2])
    stored = spark.table(names[2])
    assert stored.count() == 1
    row = stored.first()
    assert row["SEVERITY"] == "HIGH" and row["RISK_SCORE"] > 0.7 and row["analysis_version"] == "1.0"
    assert row["COMMENT"] is None
    assert read_findings(stored).count() == 1
    from veerline.sinks import analyze

    analyze(spark, names[2])
    assert read_optional(spark, "appended.nothing") is None
    assert read_optional(spark, names[2]).count() == 1


def test_numbering_is_dense_and_ordered(spark):
    many = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "process_anomaly").otherwise("network_anomaly").alias("finding_type"),
        (F.col("id") * 7919 % 5003).alias("event_id"),
    )
    rows = fd.number_findings(many).orderBy("finding_id").collect()
    assert [r["finding_id"] for r in rows] == list(range(1, 5001))
    keys = [(r["finding_type"], r["event_id"]) for r in rows]
    assert keys == sorted(keys)


def test_rule_findings(spark):
    network = frame(
        spark,
        [
            network_row(END, bytes_out=6_000_000, is_anomaly=True),
            network_row(END.replace(hour=23) - timedelta(days=1), is_anomaly=True),
            network_row(END - timedelta(hours=1), is_anomaly=True),
            network_row(END),
        ],
    )
    process = processes(spark, [process_row(END, process_name="nc.exe", is_anomaly=True)])
    reasoned = rules.with_anomaly_reason(network, (8, 18))
    rows = rules.rule_findings(reasoned, process).orderBy("finding_id").collect()
    assert [(r["severity"], r["risk_score"], r["analytic_name"]) for r in rows] == [
        ("High", 0.8, "rule_network_data_exfiltration"),
        ("Medium", 0.6, "rule_network_after_hours"),
        ("Medium", 0.6, "rule_network_None"),
        ("High", 0.9, "rule_suspicious_process"),
    ]
    assert rows[3]["src_ip"] is None and rows[3]["process_name"] == "nc.exe"


def test_exports(spark, tmp_path):
    found = loud_user(spark).findings
    export_json(found, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).first()["severity"] == "HIGH"
    export_cef(found, str(tmp_path / "cef"))
    line = spark.read.text(str(tmp_path / "cef")).first()["value"]
    assert line.startswith("CEF:0|veerline|anomaly|1.0|network_anomaly|") and "|8|externalId=" in line


def test_cef_escapes(spark):
    row = spark.createDataFrame(
        [("x", "a=b", "t", "LOW", "p|q", 0.5, "m\\n=1")],
        "finding_id string, user string, finding_type string, severity string, title string, risk_score double,"
        " description string",
    ).withColumn("event_time", F.lit("2024-01-01").cast("timestamp"))
    line = row.select(cef_line()).first()[0]
    assert "p\\|q" in line and "suser=a\\=b" in line and "msg=m\\\\n\\=1" in line


def test_event_layout_spreads_a_hot_user(spark, tmp_path):
    day = END.replace(hour=0)
    rows = [network_row(day + timedelta(seconds=10 * i), "hot") for i in range(3000)]
    rows += [network_row(day + timedelta(seconds=60 * i), f"u{i % 50}") for i in range(300)]
    path = str(tmp_path / "laid")
    write_events(frame(spark, rows), path, 6)
    stored = spark.read.parquet(path)
    assert stored.count() == 3300
    files = stored.filter("user = 'hot'").groupBy(F.input_file_name().alias("f")).count().collect()
    assert len(files) >= 4
