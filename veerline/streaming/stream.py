"""Structured Streaming variants: daily features with a watermark, scoring, alerts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import DEFAULT, Settings
from ..functions.text import finding_id
from ..operators.features import network_aggregates
from ..operators.model import RiskModel, score_batch
from ..operators.scores import attach_baseline, network_score
from ..sinks.tables import latest_baseline

STREAM_COLUMNS = (
    "daily_events", "daily_bytes_out", "daily_bytes_in", "unique_destinations", "unique_hosts",
    "active_hours", "first_activity_hour", "last_activity_hour",
)


def read_event_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).load(path)


def score_stream(stream: DataFrame, model: RiskModel, settings: Settings = DEFAULT) -> DataFrame:
    """Score a stream of feature rows; stateless, so it keeps up with any number of users."""
    return score_batch(stream, model, settings)


def stream_daily(stream: DataFrame, delay: str = "1 hour", approx: bool = False) -> DataFrame:
    """Daily features per user, emitted once a day is past the watermark.

    Events later than the delay are dropped. Two aggregations follow one another: events are gathered by user, day
    *and value*, for each of the two columns whose distinct values count, then by user and day. So no state holds a
    list of values, and a user with very many events or values is spread over all tasks. ``approx=True`` takes one
    aggregation with sketches instead; its state is one row per user and open day.
    """
    if approx:
        aggregates = network_aggregates(approx=True)
        daily = stream.withWatermark("event_time", delay).groupBy("user", F.window("event_time", "1 day"))
        return daily.agg(*[aggregates[c].alias(c) for c in STREAM_COLUMNS]).select(
            "user", F.to_date("window.start").alias("date"), *STREAM_COLUMNS
        )
    kinds = F.array(
        F.struct(F.lit("event").alias("kind"), F.lit(None).cast("string").alias("value")),
        *[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value")) for c in ("dest_ip", "dest_host")],
    )
    events = F.col("kind") == "event"
    # Distinct values only need one row per value, so they carry no sums.
    spread = stream.withWatermark("event_time", delay).select(
        "event_time", "user", F.explode(kinds).alias("x"), "bytes_out", "bytes_in", F.hour("event_time").alias("hour")
    ).select("event_time", "user", "x.*", "bytes_out", "bytes_in", "hour").filter(events | F.col("value").isNotNull())
    bit = F.call_function("shiftleft", F.lit(1), F.col("hour"))
    values = spread.groupBy("user", "kind", "value", F.window("event_time", "1 day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes_out").alias("bytes_out"), F.sum("bytes_in").alias("bytes_in"),
        F.bit_or(bit).alias("hours"), F.min("hour").alias("first"), F.max("hour").alias("last"),
    )
    whole = {
        "daily_events": F.sum(F.when(events, F.col("n"))),
        "daily_bytes_out": F.sum(F.when(events, F.col("bytes_out"))),
        "daily_bytes_in": F.sum(F.when(events, F.col("bytes_in"))),
        "unique_destinations": F.count_if(F.col("kind") == "dest_ip"),
        "unique_hosts": F.count_if(F.col("kind") == "dest_host"),
        "active_hours": F.bit_count(F.bit_or("hours")).cast("bigint"),
        "first_activity_hour": F.min("first"),
        "last_activity_hour": F.max("last"),
    }
    daily = values.groupBy("user", F.window(F.window_time("window"), "1 day").alias("day"))
    return daily.agg(*[whole[c].alias(c) for c in STREAM_COLUMNS]).select(
        "user", F.to_date("day.start").alias("date"), *STREAM_COLUMNS
    )


REVISED_COLUMNS = (*STREAM_COLUMNS, "revision")


def revised_daily(stream: DataFrame, keep: timedelta = timedelta(days=3)) -> DataFrame:
    """Daily features per user after every batch that holds an event of the day, with a ``revision`` from 1.

    An event that comes within ``keep`` of the latest one still counts; a day's state is cleared when it can get none
    any more. The state is one row of sums per open user-day, and a record of its own for each of its distinct values
    and for each batch that held an event of it, which make up the counts: no record grows, and the values of a user
    with very many of them are spread over all tasks.
    """
    day = F.window("event_time", "1 day").alias("day")
    hour = F.hour("event_time")
    # The day replaces the time of the event: what follows takes late events until the whole day is past the watermark.
    narrow = stream.withWatermark("event_time", f"{int(keep.total_seconds())} seconds").select(
        day, "user", hour.alias("hour"), "bytes_out", "bytes_in", "dest_ip", "dest_host",
        # Fixed for a batch, also if it is repeated.
        F.current_timestamp().alias("batch"),
    )
    values = [F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value")) for c in ("dest_ip", "dest_host", "batch")]
    first_seen = narrow.select("day", "user", F.explode(F.array(*values)).alias("x")).select("day", "user", "x.*")
    first_seen = first_seen.filter(F.col("value").isNotNull()).dropDuplicates(["day", "user", "kind", "value"]).drop("value")
    events = narrow.select("day", "user", F.lit("event").alias("kind"), "hour", "bytes_out", "bytes_in")
    aggregates = {
        "daily_events": F.count_if(F.col("kind") == "event"),
        "daily_bytes_out": F.sum("bytes_out"),
        "daily_bytes_in": F.sum("bytes_in"),
        "unique_destinations": F.count_if(F.col("kind") == "dest_ip"),
        "unique_hosts": F.count_if(F.col("kind") == "dest_host"),
        "active_hours": F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("hour")))).cast("bigint"),
        "first_activity_hour": F.min("hour"),
        "last_activity_hour": F.max("hour"),
        "revision": F.count_if(F.col("kind") == "batch"),
    }
    daily = events.unionByName(first_seen, allowMissingColumns=True).groupBy("user", "day")
    return daily.agg(*[aggregates[c].alias(c) for c in REVISED_COLUMNS]).select("user", F.to_date("day.start").alias("date"), *REVISED_COLUMNS)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def alert_stream(
    daily: DataFrame,
    baseline: DataFrame | str,
    path: str,
    checkpoint: str,
    settings: Settings = DEFAULT,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score user-days against the stored baseline and store those at high risk.

    ``baseline`` may be the path of a versioned store (``save_baseline`` with a version): each batch takes the newest
    version. ``trigger`` is that of the writer, ``{"processingTime": "1 minute"}`` for a stream that keeps running; by
    default what is there is processed and the query ends. Each batch owns one folder, which a repeated batch
    overwrites: restarts add no row twice. Rows of ``revised_daily`` are stored whatever their score once they are
    corrections, and ``current_alerts`` takes the last one of each user-day.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        base = latest_baseline(batch.sparkSession, baseline) if isinstance(baseline, str) else baseline
        scored = network_score(attach_baseline(batch, base), settings)
        high = F.col("network_anomaly_score") >= settings.high
        revised = [F.col("revision")] if "revision" in batch.columns else []
        alerts = scored.filter(high | (F.col("revision") > 1) if revised else high).select(
            finding_id("network_anomaly").alias("finding_id"),
            "user", "date", "network_anomaly_score", "network_anomaly_level", *revised,
        )
        alerts.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        daily.writeStream.foreachBatch(store)
        .outputMode("update" if "revision" in daily.columns else "append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def current_alerts(spark: SparkSession, path: str, settings: Settings = DEFAULT) -> DataFrame:
    """The alerts that hold now: of each user-day the last revision, if its score is still high."""
    rows = spark.read.option("mergeSchema", True).parquet(path)
    revision = F.col("revision") if "revision" in rows.columns else F.lit(1)
    kept = [c for c in rows.columns if c not in ("batch_id", "revision")]
    last = rows.groupBy("finding_id").agg(F.max_by(F.struct(*kept), F.struct(revision, F.col("batch_id"))).alias("_row"))
    return last.select("_row.*").filter(F.col("network_anomaly_score") >= settings.high)
