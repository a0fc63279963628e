"""Joins with reference data, first-seen entities, drill-downs and gaps."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..sinks.storage import broadcast_if_small
from .bounds import Bounds, in_both


def enrich_threat_intel(
    events: DataFrame, feed: DataFrame, key: str, feed_key: str | None = None, settings: Settings = DEFAULT
) -> DataFrame:
    """Events with the feed's columns, and ``threat_match``; one row per event.

    A feed entry listed twice counts once. The feed is broadcast only after its size was
    checked, so the events stay where they are; a larger feed is joined by a shuffle.
    """
    feed_key = feed_key or key
    entries = feed.withColumnRenamed(feed_key, key).dropDuplicates([key]).filter(F.col(key).isNotNull())
    entries = broadcast_if_small(entries.withColumn("threat_match", F.lit(True)), settings)
    return events.join(entries, key, "left").withColumn(
        "threat_match", F.coalesce(F.col("threat_match"), F.lit(False))
    )


def threat_hits(
    events: DataFrame, feed: DataFrame, key: str, feed_key: str | None = None, settings: Settings = DEFAULT
) -> DataFrame:
    """Only the events found in the feed."""
    entries = feed.select(F.col(feed_key or key).alias(key)).distinct()
    return events.join(broadcast_if_small(entries, settings), key, "left_semi")


def domain_with_parents(domain: Column) -> Column:
    """A domain and the domains above it, but for the last part alone: ``a.b.example`` gives itself and ``b.example``."""
    parts = F.split(F.lower(F.rtrim(domain, F.lit("."))), r"\.")
    ends = F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1)))
    return F.transform(ends, lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def _named(kind: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))


def enrich_threat_any(
    events: DataFrame,
    feed: DataFrame,
    keys: dict[str, tuple[str, ...]],
    event_key: str = "event_id",
    settings: Settings = DEFAULT,
) -> DataFrame:
    """Events with ``threat_match`` and ``threat_kinds``, from one feed of addresses, domains and hashes.

    ``feed`` has ``kind`` and ``value``; ``keys`` names the event columns of each kind (``ip``, ``domain``, ``hash``).
    All columns are looked up in one join: each event gives a row per indicator, a domain also its parents. NULL
    indicators give none, so they are never moved; with a feed that is not small, Spark filters the rows by a Bloom
    filter of it before they are shuffled. Only hits go on, and come back to the events by ``event_key``, which
    identifies an event.
    """
    cells = []
    for kind, columns in keys.items():
        for name in columns:
            values = domain_with_parents(F.col(name)) if kind == "domain" else F.array(F.lower(F.col(name).cast("string")))
            cells.append(_named(kind, values))
    found = F.filter(F.flatten(F.array_compact(F.array(*cells))), lambda x: x["value"].isNotNull())
    looked = events.select(F.col(event_key).alias("_event"), F.explode(F.array_distinct(found)).alias("x")).select("_event", "x.*")
    entries = feed.select("kind", F.lower("value").alias("value")).dropna().distinct()
    hits = looked.join(broadcast_if_small(entries, settings), ["kind", "value"])
    kinds = hits.groupBy("_event").agg(F.array_sort(F.collect_set("kind")).alias("threat_kinds"))
    joined = events.join(kinds, events[event_key] == kinds["_event"], "left").drop("_event")
    return joined.withColumns({
        "threat_match": F.col("threat_kinds").isNotNull(),
        "threat_kinds": F.coalesce("threat_kinds", F.array().cast("array<string>")),
    })


def suppress_allowlisted(
    findings: DataFrame, allow: DataFrame, keys: tuple[str, ...] = ("user",)
) -> DataFrame:
    """Findings without those whose keys are on the list of accepted behaviour."""
    return findings.join(allow.select(*keys).distinct(), list(keys), "left_anti")


def new_destinations(
    events: DataFrame, bounds: Bounds, settings: Settings = DEFAULT, destination: str = "dest_ip"
) -> DataFrame:
    """Destinations a user reached in the analysis but not in the baseline.

    One aggregation instead of an anti join: the first contact decides. Events collapse to
    one row per user and destination before they are shuffled.
    """
    pairs = in_both(events, bounds, settings).groupBy("user", destination).agg(
        F.min("event_time").alias("first_seen"), F.count(F.lit(1)).alias("events")
    )
    return pairs.filter(F.col("first_seen") >= bounds.literal("analysis_start"))


def drill_network(events: DataFrame, user: str, since: str) -> DataFrame:
    """A user's network events since an instant, latest first."""
    start = F.lit(since).cast(events.schema["event_time"].dataType)
    return (
        events.filter((F.col("user") == user) & (F.col("event_time") >= start))
        .select("event_time", "dest_host", "dest_ip", "dest_port", "bytes_out", "session_duration")
        .orderBy(F.desc("event_time"))
    )


def drill_process(events: DataFrame, user: str, since: str) -> DataFrame:
    start = F.lit(since).cast(events.schema["event_time"].dataType)
    return (
        events.filter((F.col("user") == user) & (F.col("event_time") >= start))
        .select("event_time", "process_name", "cmd_line", "md5_hash")
        .orderBy(F.desc("event_time"))
    )


def data_gaps(events: DataFrame, bounds: Bounds, settings: Settings = DEFAULT) -> DataFrame:
    """Days of the whole period on which a user has no event.

    The days a user was seen on are bits of whole numbers, 60 days each, so that events collapse
    before the only shuffle and no list is collected; the calendar is compared inside the user's row.
    """
    first, last = (date.fromisoformat(getattr(bounds, n)[:10]) for n in ("baseline_start", "analysis_end"))
    numbers = range((last - first).days // 60 + 1)
    start = F.to_date(bounds.literal("baseline_start"))
    day = F.date_diff(F.to_date("event_time"), start)
    bit = F.expr("shiftleft(1L, cast(_day % 60 as int))")
    seen = in_both(events, bounds, settings).select("user", day.alias("_day")).groupBy("user").agg(
        *[F.coalesce(F.bit_or(F.when(F.floor(F.col("_day") / 60) == i, bit)), F.lit(0)).alias(f"_seen{i}") for i in numbers]
    )
    calendar = F.sequence(start, F.to_date(bounds.literal("analysis_end")))
    missing = F.lit(False)
    for i in numbers:
        within = F.date_diff(F.col("date"), start) - 60 * i
        missing |= within.between(0, 59) & (F.getbit(f"_seen{i}", F.pmod(within, F.lit(60))) == 0)
    return seen.select("*", F.explode(calendar).alias("date")).filter(missing).select("user", "date")
