"""What Spark plans: few shuffles, pushed filters, checked broadcasts."""

from __future__ import annotations

import re

import pytest

from checks import views
from checks.views import SETTINGS
from veerline import sinks
from veerline.operators import bounds as bd, enrich, features
from veerline.operators.baseline import user_baseline_network
from veerline.plans.detection import scored_network_days

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_filters_reach_the_scan(spark):
    events = views.network(spark, SF_DIR)
    text = plan_of(bd.in_analysis(events, bd.resolve_bounds(events), SETTINGS))
    assert "GreaterThanOrEqual(ts" in text and "LessThanOrEqual(ts" in text


def test_only_needed_columns_are_read(spark):
    stored = sinks.materialise(views.network(spark, SF_DIR), "pruning")
    text = plan_of(features.daily_network(stored, ("daily_events", "active_hours")))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"event_time", "user"}


def test_hours_need_no_distinct_aggregation(spark):
    events = views.network(spark, SF_DIR)
    one = plan_of(features.daily_network(events, ("daily_events", "active_hours", "unique_destinations")))
    assert "Expand" not in one
    assert one.count("Exchange hashpartitioning") == 2


def test_unused_distinct_counts_are_dropped(spark):
    """The baseline needs destinations and hosts only: three copies of a row, not five."""
    daily = features.daily_network(views.network(spark, SF_DIR))
    text = plan_of(user_baseline_network(daily))
    expand = re.search(r"Expand \[(.*?)\]\], \[", text).group(1)
    assert expand.count("], [") == 2


def test_first_contact_takes_one_shuffle(spark):
    events = views.network(spark, SF_DIR)
    text = plan_of(enrich.new_destinations(events, bd.resolve_bounds(events), SETTINGS))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_gaps_take_one_shuffle(spark):
    events = views.network(spark, SF_DIR)
    text = plan_of(enrich.data_gaps(events, bd.resolve_bounds(events), SETTINGS))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_stored_features_are_the_only_input_of_the_scores(spark):
    events = views.network(spark, SF_DIR)
    _, scored, _ = scored_network_days(events, bd.resolve_bounds(events), SETTINGS, None, store=True)
    tables = {f.rsplit("/", 2)[1].rsplit("-", 1)[0] for f in scored.inputFiles()}
    assert tables == {"daily-network", "baseline-network"}


def test_large_feed_is_not_broadcast_by_hint(spark):
    events = views.network(spark, SF_DIR)
    feed = events.select("dest_ip").distinct()


    def hinted(settings) -> bool:
        joined = enrich.enrich_threat_intel(events, feed, "dest_ip", settings=settings)
        return "ResolvedHint" in joined._jdf.queryExecution().analyzed().toString()

    assert hinted(SETTINGS)
    assert not hinted(SETTINGS.with_(broadcast_rows=3))


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "yarn"
        applicationId = "x"

    class Conf:
        @staticmethod
        def get(name, default=None):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError):
        sinks.scratch_dir(Session())
    assert sinks.scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("daily", [features.daily_network_periods, features.daily_process_periods])
def test_events_are_never_shuffled_by_user_alone(spark, daily):
    """A user may own a third of all events: the first shuffle spreads them over values too."""
    events = (views.process if "process" in daily.__name__ else views.network)(spark, SF_DIR)
    text = plan_of(daily(events, bd.resolve_bounds(events), SETTINGS))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    keys = [[k.split("#")[0].strip() for k in e.split(",")[:-1]] for e in exchanges]
    assert len(keys) == 2
    final, first = keys
    assert final == ["user", "date", "period"]
    assert "gid" in first and len(first) > 4
    # Map-side aggregation stands below the first shuffle.
    assert "partial_sum" in text.split("Exchange hashpartitioning")[-1] or "partial_count" in text


def test_production_reads_prune_partitions(spark):
    from checks.queries import PRODUCTION, _production
    from veerline.sources import read_sources

    settings = PRODUCTION.with_(catalog=_production(spark, SF_DIR))
    for events in read_sources(spark, settings):
        bounds = bd.resolve_bounds(events, settings)
        text = plan_of(features.daily_network(bd.in_analysis(events, bounds, settings), ("daily_events",)) if "bytes_out" in events.columns
                       else bd.in_analysis(events, bounds, settings).select("user"))
        found = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
        assert "EVENT_DATE" in found and ">=" in found and "<=" in found


def test_a_daily_run_reads_the_new_days_only(spark, tmp_path):
    from veerline.plans import baseline_of_days, refresh_days, stored_days

    events, days = str(tmp_path / "events"), str(tmp_path / "days")
    sinks.write_events(views.network(spark, SF_DIR), events)
    settings = SETTINGS.with_(partition_column="date")
    table = spark.read.parquet(events)
    first = refresh_days(table.filter("date <= DATE '2024-01-28'"), days, settings)
    assert len(first) == 29
    # One day that was the last then, and those since.
    assert [str(d) for d in refresh_days(table, days, settings)] == ["2024-01-28", "2024-01-29", "2024-01-30"]
    assert [str(d) for d in refresh_days(table, days, settings)] == ["2024-01-30"]
    text = plan_of(baseline_of_days(stored_days(spark, days), first[10], first[20]))
    assert re.search(r"PartitionFilters: \[[^\]]*date", text)
