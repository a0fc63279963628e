from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from veerline.operators import features
from veerline.operators.baseline import user_baseline_network
from veerline.sinks import save_baseline
from veerline.streaming import (
    ROCKSDB,
    alert_stream,
    current_alerts,
    read_event_stream,
    revised_daily,
    stream_daily,
)

from .rows import END, frame, network_row, steady


def drain(df, path, state):
    df.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(
        path
    ).awaitTermination()


def put(spark, rows, path):
    frame(spark, rows).coalesce(1).write.mode("append").parquet(path)


def test_days_are_emitted_once_complete_and_late_rows_dropped(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    day = END.replace(hour=10)
    put(spark, [network_row(day), network_row(day, dest_ip="203.0.113.9")], source)
    schema = spark.read.parquet(source).schema
    daily = stream_daily(read_event_stream(spark, source, schema))
    drain(daily, out, state)
    assert spark.read.schema(daily.schema).parquet(out).count() == 0
    put(spark, [network_row(day + timedelta(days=1, hours=3))], source)
    drain(daily, out, state)
    rows = spark.read.parquet(out).collect()
    assert [(str(r["date"]), r["daily_events"], r["unique_destinations"], r["active_hours"]) for r in rows] == [
        ("2024-03-31", 2, 2, 1)
    ]
    # The first day is closed: another of its events comes too late.
    put(spark, [network_row(day), network_row(day + timedelta(days=3))], source)
    drain(daily, out, state)
    rows = spark.read.parquet(out).orderBy("date").collect()
    assert [(str(r["date"]), r["daily_events"]) for r in rows] == [("2024-03-31", 2), ("2024-04-01", 1)]


def test_alerts_against_the_stored_baseline(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    history = steady("ann", 15, lambda i: 2 + i % 3) + steady("bob", 15, lambda i: 2 + i % 3)
    baseline = user_baseline_network(features.daily_network(frame(spark, history)))
    loud = [network_row(END - timedelta(minutes=m), dest_ip=f"203.0.113.{m}", bytes_out=10**6) for m in range(60)]
    put(spark, loud + [network_row(END, "bob"), network_row(END + timedelta(days=2), "bob")], source)
    stream = read_event_stream(spark, source, spark.read.parquet(source).schema)
    for _ in range(2):  # A restart finds nothing new and adds nothing.
        alert_stream(stream_daily(stream), baseline, out, state).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert [(r["user"], str(r["date"]), r["network_anomaly_level"]) for r in rows] == [("ann", "2024-03-31", "HIGH")]


def test_a_repeated_batch_overwrites_itself(spark, tmp_path):
    """Losing the stream's own state replays every batch; the alerts are the same."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    history = steady("ann", 15, lambda i: 2 + i % 3)
    baseline = user_baseline_network(features.daily_network(frame(spark, history)))
    loud = [network_row(END - timedelta(minutes=m), dest_ip=f"203.0.113.{m}", bytes_out=10**6) for m in range(60)]
    put(spark, loud + [network_row(END + timedelta(days=2), "bob")], source)
    stream = read_event_stream(spark, source, spark.read.parquet(source).schema)
    for _ in range(2):
        alert_stream(stream_daily(stream), baseline, out, str(tmp_path / uuid.uuid4().hex)).awaitTermination()
    assert spark.read.parquet(out).groupBy("finding_id").count().filter(F.col("count") > 1).count() == 0
    assert spark.read.parquet(out).count() == 1


def test_distinct_values_are_exact(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    day = END.replace(hour=1)
    rows = [network_row(day + timedelta(seconds=20 * i), dest_ip=f"10.0.{i % 130}.1", dest_host=None if i % 2 else f"h{i % 14}", bytes_in=None) for i in range(2000)]
    put(spark, rows + [network_row(day + timedelta(days=3), "bob")], source)
    daily = stream_daily(read_event_stream(spark, source, spark.read.parquet(source).schema))
    for _ in range(2):
        drain(daily, out, state)
    row = spark.read.schema(daily.schema).parquet(out).filter("user = 'ann'").first()
    assert (row["daily_events"], row["unique_destinations"], row["unique_hosts"], row["daily_bytes_in"]) == (2000, 130, 7, None)
    assert (row["active_hours"], row["first_activity_hour"], row["last_activity_hour"]) == (12, 1, 12)


def test_alerts_are_corrected_by_late_events(spark, tmp_path):
    source, out, state, base = (str(tmp_path / n) for n in ("in", "out", "state", "base"))
    history = steady("ann", 15, lambda i: 2 + i % 3)
    baseline = user_baseline_network(features.daily_network(frame(spark, history)))
    save_baseline(baseline, base, 7)
    quiet = [network_row(END - timedelta(minutes=m), dest_ip=f"203.0.113.{m}") for m in range(3)]
    loud = [network_row(END - timedelta(minutes=m), dest_ip=f"203.0.113.{m}", bytes_out=10**6) for m in range(3, 60)]
    seen = []
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        for rows in (quiet, [network_row(END + timedelta(days=1), "bob")], loud):
            put(spark, rows, source)
            stream = read_event_stream(spark, source, spark.read.parquet(source).schema)
            alert_stream(revised_daily(stream), base, out, state).awaitTermination()
            seen.append(sorted((r["user"], str(r["date"])) for r in current_alerts(spark, out).collect()))
        # A baseline that knows such days takes the alert back with the next event.
        save_baseline(baseline.withColumn("baseline_avg_bytes_out", F.lit(5.7e7)).withColumn("baseline_avg_events", F.lit(60.0)), base, 8)
        put(spark, [network_row(END)], source)
        alert_stream(revised_daily(stream), base, out, state).awaitTermination()
        seen.append(current_alerts(spark, out).count())
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert seen == [[], [], [("ann", "2024-03-31")], 0]


def test_revised_days_need_no_python_and_no_state_store_of_their_own(spark, tmp_path):
    """Every batch sends the days that it touches, whole; a day behind the watermark takes nothing more."""
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    day = END.replace(hour=9)
    first = [network_row(day + timedelta(minutes=i), f"u{i % 200}", dest_ip=f"10.0.0.{i % 7}", bytes_in=None) for i in range(400)]
    second = [network_row(day.replace(hour=3), "u1", dest_ip="10.9.9.9", dest_host=None), network_row(day.replace(hour=9), "u1", dest_ip="10.0.0.1")]
    batches = [first, second, [network_row(day + timedelta(days=6), "bob")], [network_row(day, "u1"), network_row(day + timedelta(days=6), "bob")]]
    seen = []

    def keep(batch, _):
        seen.append({(r["user"], str(r["date"])): r.asDict() for r in batch.collect()})

    for rows in batches:
        put(spark, rows, source)
        daily = revised_daily(read_event_stream(spark, source, spark.read.parquet(source).schema))
        assert "TransformWithState" not in daily._jdf.queryExecution().logical().toString()
        daily.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    seen = [batch for batch in seen if batch]
    assert [len(batch) for batch in seen] == [200, 1, 1, 1]
    u1 = [batch["u1", "2024-03-31"] for batch in seen[:2]]
    assert [(r["revision"], r["daily_events"], r["unique_destinations"], r["unique_hosts"]) for r in u1] == [(1, 2, 2, 1), (2, 4, 3, 1)]
    assert [(r["daily_bytes_out"], r["daily_bytes_in"], r["active_hours"], r["first_activity_hour"], r["last_activity_hour"]) for r in u1] == [
        (200, None, 2, 9, 12), (400, 20, 3, 3, 12)
    ]
    assert [(r["revision"], r["daily_events"]) for batch in seen[2:] for r in batch.values()] == [(1, 1), (2, 2)]
