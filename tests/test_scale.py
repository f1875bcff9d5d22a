"""What bounds the work and the traffic of refreshes and comparisons on large tables."""

import re
import threading

from conftest import CAMPAIGN, EVENT, PROFILE, plain
from test_refresh import iso, land

from lamina.feeds import CAMPAIGNS, CLIENT_PROFILES, ENGAGEMENT_EVENTS
from lamina.operators.contract import differences
from lamina.operators.star import fact_engagement_daily
from lamina.plans import publish, queries
from lamina.plans.bindings import FEEDS
from lamina.plans.refresh import FULL, INCREMENTAL, Settings, refresh
from lamina.session import BROADCAST, BROADCAST_MOST, pin_session
from lamina.sources.landing import set_modified


def test_only_comparisons_build_the_second_lake(spark, tmp_path, monkeypatch):
    modes = []
    monkeypatch.setattr(queries, "land_feed", lambda *_: None)
    monkeypatch.setattr(queries, "refresh", lambda _spark, _settings, mode: modes.append(mode) or f"lake {len(modes)}")
    source = str(tmp_path)
    assert queries.grown_lake(spark, source) == "lake 2"
    assert modes == [INCREMENTAL, INCREMENTAL]
    assert queries.late_lakes(spark, source) == queries.late_lakes(spark, source) == ("lake 2", "lake 3")
    assert modes == [INCREMENTAL, INCREMENTAL, FULL]


def test_a_session_broadcasts_little_unless_it_says_so(spark):
    fresh = pin_session(spark.newSession())
    assert fresh.conf.get(BROADCAST) == BROADCAST_MOST
    fresh.conf.set(BROADCAST, "7m")
    assert pin_session(fresh).conf.get(BROADCAST) == "7m"


def test_a_side_of_many_compressed_rows_is_not_broadcast(spark, tmp_path):
    session = pin_session(spark.newSession())
    rows = session.range(600_000).selectExpr("id", "uuid() AS name")
    rows.coalesce(1).write.parquet(f"{tmp_path}/rows")
    stored = session.read.parquet(f"{tmp_path}/rows")
    # Several MB by the estimate: within Spark's own limit, beyond this one.
    plan = stored.join(stored.select("id"), "id", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_comparison_sends_hashes_and_counts_copies_nulls_and_nested_values(spark):
    schema = "a string, b string, c array<string>, d int"
    left = spark.createDataFrame(
        [("x", None, None, 1), (None, "x", None, 1), ("y", "y", ["p", None], 2), ("y", "y", ["p"], 2), ("z", "z", [], 3), ("z", "z", [], 3)], schema
    )
    right = spark.createDataFrame(
        [("x", None, None, 1), ("x", None, None, 1), ("y", "y", ["p", None], 2), ("z", "z", [], 3), (None, None, None, None)], schema
    )
    # The other side has d as long: equal after the union of both.
    found = differences(left, right.withColumn("d", right["d"].cast("long")))
    assert [tuple(row) for row in found.collect()] == [(6, 5, 3, 2)]
    plan = differences(left.drop("c"), right.drop("c"))._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(keys) == 1 and all(name.strip().startswith("_hash_") for name in keys[0].split(",")[:2]), plan


def test_feeds_land_side_by_side(spark, tmp_path, monkeypatch):
    landed, all_there = [], threading.Barrier(len(FEEDS), timeout=20)
    monkeypatch.setattr(queries, "land_feed", lambda _spark, _source, feed, *_: all_there.wait() >= 0 and landed.append(feed.name))
    monkeypatch.setattr(queries, "_home", lambda _spark: Settings(f"{tmp_path}/landing", f"{tmp_path}/lake"))

    class Star:
        def published(self, _spark, name):
            return name, len(landed)

    monkeypatch.setattr(queries, "refresh", lambda *_: Star())
    assert queries.fact_incremental(spark, str(tmp_path)) == ("fact_engagement_daily", 2 * len(FEEDS))
    assert sorted(landed) == sorted(2 * [feed.name for feed in FEEDS])


def test_touched_events_are_looked_up_once_for_both_states(spark, tmp_path, monkeypatch):
    settings = Settings(f"{tmp_path}/landing", f"{tmp_path}/lake", buckets=2)
    clients = [{**PROFILE, "client_id": f"CL-{i:06d}"} for i in range(4)]
    events = [
        {**EVENT, "event_id": f"EVT-{i:08d}", "client_id": f"CL-{i % 4:06d}", "event_timestamp": iso(86_400 * (1 + i % 3))}
        for i in range(24)
    ]
    change = {**PROFILE, "client_id": "CL-000001", "operation": "UPDATE", "operation_timestamp": iso(2 * 86_400)}
    # The second delivery is older, so its copy of the first event replaces that, which lay on another day.
    again = {**events[0], "event_timestamp": iso(5 * 86_400)}
    new = {**EVENT, "event_id": "EVT-00000099", "client_id": "CL-000003", "event_timestamp": iso(9 * 86_400)}
    for number, rows in enumerate(((clients, [CAMPAIGN], events), ([change], [CAMPAIGN], [again, new]))):
        for feed, landed in zip((CLIENT_PROFILES, CAMPAIGNS, ENGAGEMENT_EVENTS), rows):
            land(spark, settings, feed, number, landed)
            set_modified(spark, f"{settings.folder(feed)}/delivery-{number}", 1_700_000_000_000 - number * 1_000)
        if number == 0:
            refresh(spark, settings)
    sides = []

    def recorded(events, history, *rest):
        sides.append((events, history))
        return fact_engagement_daily(events, history, *rest)

    monkeypatch.setattr(publish, "fact_engagement_daily", recorded)
    lake = refresh(spark, settings)
    (later, versions), (former, _) = sides
    assert all("/_staging/touched_events/" in path for path in former.inputFiles())
    assert all("/_staging/versions_of_events/" in path for path in versions.inputFiles())
    assert not [path for df in (later, versions, former) for path in df.inputFiles() if "/touched_groups/" in path]

    def shown(df):
        return sorted((row.event_id, row.event_timestamp.isoformat()) for row in df.collect())

    # All of the campaign that was delivered again, minus the copy given up, plus both new rows.
    assert len(shown(former)) == 24 and len(shown(later)) == 25
    assert {row[0] for row in set(shown(later)) ^ set(shown(former))} == {"EVT-00000000", "EVT-00000099"}
    assert [row[0] for row in shown(later)].count("EVT-00000000") == 1
    whole = fact_engagement_daily(lake.clean(spark, ENGAGEMENT_EVENTS), lake.history(spark), lake.clean(spark, CAMPAIGNS))
    assert plain(lake.published(spark, "fact_engagement_daily").collect()) == plain(whole.collect())
