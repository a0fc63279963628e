from __future__ import annotations

import json

from veerline import schemas
from veerline.config import DEFAULT
from veerline.functions import parse_ocsf_ts
from veerline.sources import flatten_finding, flatten_network, flatten_process, read_ocsf_csv, read_optional, read_sources


def cell(value) -> str:
    return '"' + json.dumps(value, indent=2).replace('"', '""') + '"'


def record(schema, cells: dict[str, str]) -> str:
    names = [f.name for f in schema][::-1]  # The feed's column order differs from the table's.
    return "﻿" + ",".join(names) + "\n" + ",".join(cells.get(n, "") for n in names) + "\n"


NETWORK_CELLS = {
    "EVENT_TIME": "2024-03-01 15:06:26.000",
    "START_TIME": "2024-03-01 08:06:11.000 -0700",
    "LOAD_TS": "2024-03-01 15:14:33.507 Z",
    "APP_NAME": "ssl",
    "DEST_PORT": "443",
    "SRC_IP": "10.9.9.9",
    "DEST_IP": "203.0.113.5",
    "DEST_HOST": "fw-9",
    "DISPOSITION": "Allowed",
    "CONNECTION_INFO": cell({"direction": "Outbound", "protocol_name": "tcp", "session": {"count": 1, "uid": "7"}}),
    "DST_ENDPOINT": cell({"domain": "d.example", "name": "fw-9", "port": 443, "location": {"country": "Norway"}}),
    "SRC_ENDPOINT": cell({"ip": "10.9.9.9", "owner": "corp\\ann", "port": 50001}),
    "TRAFFIC": cell({"bytes": 30, "bytes_in": 20, "bytes_out": 10, "packets_in": 2, "packets_out": 1}),
}


def test_csv_with_byte_order_mark_and_json_over_lines(spark, tmp_path):
    path = tmp_path / "n.csv"
    path.write_text(record(schemas.OCSF_NETWORK, NETWORK_CELLS), encoding="utf-8")
    rows = read_ocsf_csv(spark, str(path), schemas.OCSF_NETWORK)
    assert rows.count() == 1
    assert rows.schema.fieldNames() == schemas.OCSF_NETWORK.fieldNames()
    row = rows.first()
    assert str(row["START_TIME"]) == "2024-03-01 15:06:11"
    assert str(row["LOAD_TS"]) == "2024-03-01 15:14:33.507000"
    assert len(read_ocsf_csv(spark, str(path)).columns) == 70
    flat = flatten_network(rows).first()
    assert (flat["user"], flat["src_port"], flat["dest_host"]) == ("corp\\ann", 50001, "d.example")
    assert (flat["bytes_in"], flat["bytes_out"], flat["protocol"], flat["dest_country"]) == (20, 10, "tcp", "Norway")
    assert flat["session_duration"] is None and flat["action"] == "Allowed"


def test_rows_without_user_keep_their_address(spark, tmp_path):
    path = tmp_path / "n.csv"
    path.write_text(record(schemas.OCSF_NETWORK, {**NETWORK_CELLS, "SRC_ENDPOINT": ""}), encoding="utf-8")
    flat = flatten_network(read_ocsf_csv(spark, str(path), schemas.OCSF_NETWORK)).first()
    assert flat["user"] == "10.9.9.9"


def test_process_columns_win_over_the_json_cell(spark, tmp_path):
    cells = {
        "EVENT_TIME": "2024-03-01 15:06:26.000",
        "_USER": "ann",
        "_HOST": "h1",
        "PROCESS_NAME": "cmd.exe",
        "PROCESS": cell(
            {
                "name": "other.exe", "cmd_line": "cmd /c dir", "pid": 7, "parent_process": {"name": "explorer.exe", "pid": 3},
                "file": {"path": "C:/cmd.exe", "hashes": [{"algorithm": "SHA-256", "value": "ff"}]},
            }
        ),
    }
    path = tmp_path / "p.csv"
    path.write_text(record(schemas.OCSF_PROCESS, cells), encoding="utf-8")
    flat = flatten_process(read_ocsf_csv(spark, str(path), schemas.OCSF_PROCESS)).first()
    assert (flat["process_name"], flat["cmd_line"], flat["process_path"]) == ("cmd.exe", "cmd /c dir", "C:/cmd.exe")
    assert (flat["parent_process"], flat["pid"], flat["parent_pid"], flat["sha256_hash"]) == ("explorer.exe", 7, 3, "ff")


def test_finding_cells(spark, tmp_path):
    cells = {
        "EVENT_TIME": "2024-03-01 15:06:26.000",
        "SEVERITY": "Informational",
        "FINDING_INFO": cell(
            {
                "analytic": {"name": "r1", "type": "rule", "type_id": 1, "uid": "u"},
                "first_seen_time": 1709305586, "title": "t", "type": ["url", "THREAT", None], "uid": "9",
            }
        ),
        "EVIDENCES": cell(
            {
                "src_endpoint": {"ip": "10.0.0.1", "owner": None}, "dst_endpoint": {"ip": "203.0.113.1", "domain": "d"},
                "url": {"url_string": "d/"}, "protocol_name": "tcp",
            }
        ),
    }
    path = tmp_path / "f.csv"
    path.write_text(record(schemas.OCSF_FINDING, cells), encoding="utf-8")
    flat = flatten_finding(read_ocsf_csv(spark, str(path), schemas.OCSF_FINDING)).first()
    assert (flat["analytic_name"], flat["finding_types"], flat["url"]) == ("r1", ["url", "THREAT"], "d/")
    assert str(flat["first_seen_time"]) == "2024-03-01 15:06:26"
    assert flat["risk_score"] is None


def test_three_time_formats_are_one_instant(spark):
    cells = [("2024-03-01 08:06:26.000 -0700",), ("2024-03-01 15:06:26.000 Z",), ("2024-03-01 15:06:26.000",)]
    rows = spark.createDataFrame([*cells, ("nonsense",)], "t string").select(parse_ocsf_ts("t").alias("t")).collect()
    assert [str(r["t"]) for r in rows] == ["2024-03-01 15:06:26"] * 3 + ["None"]


def test_source_tables_follow_the_switch(spark):
    assert DEFAULT.source_tables()["network"] == "security.network_activity_synthetic"
    assert DEFAULT.with_(synthetic=False, catalog="soc").source_tables() == {
        "network": "soc.network_activity", "process": "soc.process_activity", "findings": "soc.detection_finding",
    }
    assert read_optional(spark, "/nowhere/at/all") is None


def test_daily_run_over_tables(spark):
    from datetime import timedelta

    from veerline.plans import run_detection, run_training

    from .rows import END, frame, network_row, steady

    spark.sql("CREATE DATABASE IF NOT EXISTS daily")
    rows = []
    for i in range(8):
        rows += steady(f"u{i}", 15, lambda d, i=i: 2 + (d + i) % 4)
    rows += [network_row(END - timedelta(minutes=m), "u0", bytes_out=10**6, dest_ip=f"203.0.113.{m}") for m in range(60)]
    frame(spark, rows).write.mode("overwrite").saveAsTable("daily.network_activity_synthetic")
    settings = DEFAULT.with_(catalog="daily", peer_groups=2)
    network, process = read_sources(spark, settings)
    assert network.count() == len(rows) and process is None
    found, summary = run_detection(spark, settings)
    run_detection(spark, settings)
    stored = spark.table("daily.detection_finding")
    assert stored.count() == found.findings.count() == 1
    items = {(r["section"], r["item"]): r["value"] for r in summary.collect()}
    assert items[("data", "network_events")] >= 60
    assert items[("findings", "HIGH")] == 1
    trained = run_training(spark, f"{spark.conf.get('spark.checkpoint.dir')}/model-daily", "v7", settings)
    assert trained.model.columns[0] == "baseline_avg_events"
