"""Properties of the physical plans that matter at scale."""

import re

import pytest
from conftest import moment

from lamina.feeds import CLIENT_PROFILES, FEEDS
from lamina.functions.skew import heavy_keys
from lamina.operators.history import profile_history
from lamina.operators.quality import clean, quarantine
from lamina.operators.star import dim_client, effective_events, fact_engagement_daily


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Empty stored tables: plans look as they do on data, without its sizes."""
    root = tmp_path_factory.mktemp("stored")
    frames = {}
    for feed in FEEDS:
        folder = f"{root}/{feed.name}"
        spark.createDataFrame([], feed.raw_schema).write.parquet(folder)
        typed = spark.createDataFrame([], feed.typed_schema)
        typed.write.parquet(f"{folder}_clean")
        frames[feed.raw_table] = spark.read.schema(feed.raw_schema).parquet(folder)
        frames[feed.clean_table] = spark.read.schema(feed.typed_schema).parquet(f"{folder}_clean")
    profile_history(frames["client_profile_changes"]).write.parquet(f"{root}/history")
    frames["history"] = spark.read.parquet(f"{root}/history")
    return frames


NEVER = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "MapInArrow")


def fact_of(stored, heavy=None):
    return fact_engagement_daily(
        stored["engagement_events_clean"], stored["history"], stored["campaigns_clean"], heavy
    )


def test_no_plan_crosses_sides_or_leaves_the_jvm(spark, stored):
    heavy = heavy_keys(stored["engagement_events_clean"], ["client_id"])
    plans = [plan_of(fact_of(stored)), plan_of(fact_of(stored, heavy))]
    plans += [plan_of(clean(stored[feed.raw_table], feed)) for feed in FEEDS]
    plans += [plan_of(quarantine(stored[feed.raw_table], feed)) for feed in FEEDS]
    plans += [plan_of(profile_history(stored["client_profile_changes"], heavy))]
    for plan in plans:
        assert not [word for word in NEVER if word in plan], plan


def test_row_wise_tables_do_not_shuffle(stored):
    for feed in FEEDS:
        assert "Exchange" not in plan_of(quarantine(stored[feed.raw_table], feed))
    assert "Exchange" not in plan_of(dim_client(stored["history"]))


def test_dedup_drops_copies_before_its_one_shuffle(stored):
    for feed in FEEDS:
        plan = plan_of(clean(stored[feed.raw_table], feed))
        assert shuffles(plan) == 1
        before = plan[plan.index("Exchange hashpartitioning"):]
        assert "row_number(), 1, Partial" in before, plan


def test_history_takes_one_shuffle(stored):
    assert shuffles(plan_of(profile_history(stored["client_profile_changes"]))) == 1


def test_fact_reads_only_what_it_needs_and_hashes_after_grouping(stored):
    plan = plan_of(fact_of(stored))
    # The as-of shuffle by client also serves the grouping, whose keys include the client.
    assert shuffles(plan) == 1, plan
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    columns = sorted((sorted(re.sub(r"#\d+L?", "", scan).split(",")) for scan in scans), key=len)
    assert columns == [
        ["campaign_id"],
        ["__END_AT", "__START_AT", "client_id"],
        ["campaign_id", "channel", "client_id", "engagement_seconds", "event_id",
         "event_timestamp", "event_type"],
    ]
    assert "sha2" not in plan[plan.index("partial_count"):]
    assert "LeftSemi" in plan


def test_selective_reads_reach_the_scan(stored):
    day = moment(0)
    placed = effective_events(
        stored["engagement_events_clean"].where(
            stored["engagement_events_clean"].event_timestamp >= day
        ),
        stored["history"],
    )
    assert "GreaterThanOrEqual(event_timestamp" in plan_of(placed)
    one = clean(stored[CLIENT_PROFILES.raw_table], CLIENT_PROFILES).where("client_id = 'CL-000001'")
    assert "EqualTo(client_id,CL-000001)" in plan_of(one)
