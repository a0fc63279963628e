"""Hand-made events."""

from __future__ import annotations

from datetime import datetime, timedelta

from veerline import schemas

END = datetime(2024, 3, 31, 12, 0, 0)


def network_row(at: datetime, user: str = "ann", **changes):
    row = dict(
        event_id=0, event_time=at, user=user, src_ip="10.0.0.1", src_port=50000, dest_ip="203.0.113.1",
        dest_host="a.example", dest_port=443, protocol="tcp", app_name="ssl", bytes_in=10, bytes_out=100,
        packets_in=1, packets_out=1, session_duration=5, action="Allowed", is_anomaly=False, anomaly_reason=None,
    )
    row.update(changes)
    return row


def process_row(at: datetime, user: str = "ann", **changes):
    row = dict(
        event_id=0, event_time=at, user=user, host="h1", process_name="excel.exe", process_path="/p",
        cmd_line="x", parent_process="explorer.exe", pid=1, parent_pid=2, md5_hash="m", sha256_hash="s",
        os_platform="Win", is_anomaly=False, anomaly_reason=None,
    )
    row.update(changes)
    return row


def frame(spark, rows, schema=schemas.NETWORK_EVENTS):
    from pyspark.sql import types as T

    names = [f.name for f in schema]
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    ids = [dict(r, event_id=r["event_id"] or i) for i, r in enumerate(rows, 1)]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in ids], nullable)


def processes(spark, rows):
    return frame(spark, rows, schemas.PROCESS_EVENTS)


def steady(user: str, days: int, per_day, start_back: int = 28, **changes):
    """``per_day`` events (a number, or a function of the day) at 10:00 on each baseline day.

    Every event of a day goes to another address.
    """
    rows = []
    for i in range(days):
        count = per_day(i) if callable(per_day) else per_day
        day = (END - timedelta(days=start_back - 1 - i)).replace(hour=10, minute=0)
        for m in range(count):
            cells = {"dest_ip": f"203.0.113.{m}", **changes}
            rows.append(network_row(day + timedelta(minutes=m), user, **cells))
    return rows
