"""Log-structured tables, publication by pointer, signed differences, late older files, cuts of heavy keys."""

import random
from bisect import bisect_left, bisect_right

import pytest
from conftest import CAMPAIGN, EVENT, PROFILE, moment, plain
from test_refresh import compared, iso, land, small_feeds

from lamina.feeds import CAMPAIGNS, CLIENT_PROFILES, ENGAGEMENT_EVENTS, FEEDS
from lamina.functions.skew import heavy_or_none
from lamina.operators.history import END, START, type2_history
from lamina.operators.star import FACT_MEASURES, fact_difference, fact_engagement_daily, merged_fact
from lamina.operators.timeline import attach_effective, time_cuts
from lamina.plans import publish
from lamina.plans.batch import BatchTables
from lamina.plans.refresh import FULL, INCREMENTAL, Settings, new_lake, refresh, take_in
from lamina.sources.lake import DAY
from lamina.sources.landing import set_modified
from lamina.sources.log_table import LogTable
from lamina.sources.members import Members, earlier_copies

ROWS = "k string, v int"


def frame(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def test_newest_rebuild_of_a_key_counts(spark, tmp_path):
    log = LogTable(str(tmp_path), frame(spark, []).schema, ("k",))
    assert log.live(spark).collect() == [] and log.last(spark) == -1
    log.append(frame(spark, [("a", 1), ("a", 2), ("b", 3), (None, 4)]), None, 0)
    log.append(frame(spark, [("a", 5)]), frame(spark, [("a", 0), ("c", 0)]), 1)
    log.append(frame(spark, [("d", 6)]), frame(spark, [("b", 0), (None, 0)]), 2)
    log.append(frame(spark, [("d", 6)]), frame(spark, [("b", 0), (None, 0)]), 2)
    states = [plain(log.live(spark, n).select("k", "v").collect()) for n in range(3)]
    assert states == [
        plain([("a", 1), ("a", 2), ("b", 3), (None, 4)]), plain([("a", 5), ("b", 3), (None, 4)]), plain([("a", 5), ("d", 6)]),
    ]
    log.write_base(log.live(spark, 1), 1)
    log.append(frame(spark, []), frame(spark, [("a", 0)]), 3)
    for base in (-1, 1):
        assert plain(log.live(spark, 2, base).select("k", "v").collect()) == states[2]
        assert plain(log.live(spark, 3, base).select("k", "v").collect()) == [("d", 6)]
        assert plain(spark.sql(log.sql(["k", "v"], 3, base)).collect()) == [("d", 6)]
    log.expire(spark, 1)
    assert plain(log.live(spark, 3, 1).select("k", "v").collect()) == [("d", 6)]
    assert log.rebuilt(spark, 1, 3).count() == 3


def test_a_long_side_is_not_shuffled_by_a_short_log(spark, tmp_path):
    log = LogTable(str(tmp_path), frame(spark, []).schema, ("k",))
    log.append(spark.range(20_000).selectExpr("cast(id AS string) AS k", "1 AS v"), None, 0)
    log.append(frame(spark, [("7", 2)]), frame(spark, [("7", 0)]), 1)
    live = log.live(spark)
    assert live.count() == 20_000
    plan = live._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "SortMergeJoin" not in plan


def many_clients(n):
    return [{**PROFILE, "client_id": f"CL-{i:06d}"} for i in range(n)]


def test_few_changed_clients_write_only_their_versions(spark, tmp_path):
    settings = Settings(f"{tmp_path}/landing", f"{tmp_path}/lake", buckets=4)
    land(spark, settings, CLIENT_PROFILES, 0, many_clients(60))
    land(spark, settings, CAMPAIGNS, 0, [CAMPAIGN])
    events = [{**EVENT, "event_id": f"EVT-{i:08d}", "client_id": f"CL-{i % 60:06d}", "event_timestamp": iso(86_400 * (1 + i % 3))} for i in range(240)]
    land(spark, settings, ENGAGEMENT_EVENTS, 0, events)
    refresh(spark, settings)
    change = {**PROFILE, "client_id": "CL-000007", "operation": "UPDATE", "operation_timestamp": iso(90_000)}
    land(spark, settings, CLIENT_PROFILES, 1, [change])
    lake = refresh(spark, settings)
    log = lake.history_log
    assert sorted({r.client_id for r in log.log(spark, 0).collect()}) == ["CL-000007"] and log.log(spark, 0).count() == 2
    assert [r.client_id for r in log.rebuilt(spark, 0).collect()] == ["CL-000007"]
    clients = lake.dim_client_log(spark)
    assert clients.log(spark, 0).count() == 2 and lake.published(spark, "dim_client").count() == 61
    # The fact: only groups of that client, on days at or after the change, minus and plus.
    moved = lake.fact_log.log(spark, 0).collect()
    assert {r.client_key for r in moved} <= {r.client_key for r in clients.log(spark, 0).collect()}
    assert sorted(r.event_count for r in moved) == [-2, 2] or sum(r.event_count for r in moved) == 0
    again = fact_engagement_daily(lake.clean(spark, ENGAGEMENT_EVENTS), lake.history(spark), lake.clean(spark, CAMPAIGNS))
    assert plain(lake.published(spark, "fact_engagement_daily").collect()) == plain(again.collect())


def test_a_failure_between_two_writes_leaves_the_former_star(spark, tmp_path, monkeypatch):
    settings = Settings(f"{tmp_path}/landing", f"{tmp_path}/lake", buckets=2)
    feeds = small_feeds(random.Random(8))
    for feed, rows in feeds.items():
        land(spark, settings, feed, 0, rows[::2])
    lake = refresh(spark, settings)
    names = ("dim_client", "dim_campaign", "fact_engagement_daily")
    former = {name: plain(lake.published(spark, name).collect()) for name in names}
    for feed, rows in feeds.items():
        land(spark, settings, feed, 1, rows[1::2])
    # The dimensions get written, the fact fails; then all three get written and the pointer fails.
    for broken in ("fact_difference", "_move_pointer"):
        with monkeypatch.context() as patch:
            def fail(*_, **__):
                raise OSError("no space left")

            patch.setattr(publish, broken, fail)
            with pytest.raises(OSError):
                refresh(spark, settings)
        assert {name: plain(lake.published(spark, name).collect()) for name in names} == former
    lake = refresh(spark, settings)
    raw = {feed.name: lake.raw(spark, feed) for feed in FEEDS}
    assert compared(BatchTables(raw).published_tables()) == compared({name: lake.published(spark, name) for name in names})
    assert {name: plain(lake.published(spark, name).collect()) for name in names} != former


def test_old_publications_are_removed_and_the_last_two_stay(spark, tmp_path):
    settings = Settings(f"{tmp_path}/landing", f"{tmp_path}/lake", buckets=2)
    seen = []
    for number in range(5):
        land(spark, settings, CLIENT_PROFILES, number, [{**PROFILE, "operation_timestamp": iso(number * 100)}])
        land(spark, settings, CAMPAIGNS, number, [{**CAMPAIGN, "campaign_id": f"CMP-{number:04d}"}])
        lake = refresh(spark, settings)
        seen.append(lake.last_publication(spark))
        assert lake.published(spark, "dim_client").count() == lake.published(spark, "dim_campaign").count() == number + 1
    assert seen[-1].dim_client_base > 0 and seen[-1].history_base > 0
    for at, rows in ((seen[-1], 5), (seen[-2], 4)):
        assert lake.published(spark, "dim_client", at).count() == lake.published(spark, "dim_campaign", at).count() == rows
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lake.published(spark, "dim_campaign", seen[0])


def test_older_files_that_land_late_give_the_same_tables(spark, tmp_path):
    rng = random.Random(1)
    feeds = small_feeds(rng)
    settings = Settings(f"{tmp_path}/landing", f"{tmp_path}/lake", buckets=3)
    ages = [3, 1, 4, 2]
    for number, age in enumerate(ages):
        for feed, rows in feeds.items():
            land(spark, settings, feed, number, rows[number :: len(ages)])
            set_modified(spark, f"{settings.folder(feed)}/delivery-{number}", 1_700_000_000_000 + age * 3_600_000)
        lake = refresh(spark, settings, INCREMENTAL)
    step_by_step = compared(lake.tables(spark))
    raw = {feed.name: lake.raw(spark, feed) for feed in FEEDS}
    batch = BatchTables(raw)
    at_once = {feed.clean_table: batch.clean(feed) for feed in FEEDS}
    at_once |= {"client_profile_history": batch.history}
    at_once |= batch.quarantine_tables() | batch.published_tables() | batch.raw_tables()
    assert step_by_step == compared(at_once)
    assert any(lake.arrivals_log(feed).rebuilt(spark).count() for feed in FEEDS)
    assert compared(refresh(spark, settings, FULL).tables(spark)) == step_by_step


def test_an_older_copy_takes_back_what_followed_from_the_younger(spark, tmp_path):
    """The younger copies are good, the older ones bad: everything they led to disappears."""
    settings = Settings(f"{tmp_path}/landing", f"{tmp_path}/lake", buckets=2)
    for number, (profile, campaign, event) in enumerate((
        (PROFILE, CAMPAIGN, EVENT),
        ({**PROFILE, "lifecycle_stage": "Unknown"}, CAMPAIGN, {**EVENT, "event_timestamp": iso(9 * 86400)}),
        (PROFILE, {**CAMPAIGN, "status": "ARCHIVED"}, EVENT),
    )):
        for feed, row in zip((CLIENT_PROFILES, CAMPAIGNS, ENGAGEMENT_EVENTS), (profile, campaign, event)):
            land(spark, settings, feed, number, [row])
            set_modified(spark, f"{settings.folder(feed)}/delivery-{number}", 1_700_000_000_000 - number * 1_000)
        lake = refresh(spark, settings)
        sizes = [lake.history(spark).count(), lake.published(spark, "dim_campaign").count(), lake.published(spark, "fact_engagement_daily").count()]
        assert sizes == [[1, 1, 1], [0, 1, 0], [1, 0, 0]][number]
        assert lake.published(spark, "dim_client").count() == sizes[0]


def test_differences_lead_from_one_fact_to_another(spark):
    columns = "activity_date date, client_key string, campaign_key string, channel string, " + ", ".join(f"{m} long" for m in FACT_MEASURES) + ", synthetic_record boolean"

    def fact(counts):
        rows = [(moment(0).date(), key, "c", None if key == "n" else "EMAIL", *[n] * len(FACT_MEASURES), True) for key, n in counts.items()]
        return spark.createDataFrame(rows, columns)

    before, now = fact({"a": 3, "b": 2, "n": 5, "same": 1}), fact({"a": 4, "c": 1, "n": 6, "same": 1})
    moved = fact_difference(now, before)
    assert {r.client_key: r.event_count for r in moved.collect()} == {"a": 1, "b": -2, "c": 1, "n": 1}
    assert plain(merged_fact(before, moved).collect()) == plain(now.collect())


def test_pieces_stay_small_whatever_the_times(spark):
    """60 % of a heavy client's changes in one minute, a third of its events at one time."""
    rng = random.Random(5)
    changes = [("hot", moment(3_000).replace(microsecond=i) if i < 1800 else moment(rng.randrange(10**6)), i) for i in range(3000)]
    changes += [(f"c{i % 50}", moment(i), i) for i in range(200)]
    events = [("hot", moment(500_000) if i % 3 == 0 else moment(rng.randrange(10**6)), i) for i in range(6000)]
    c = spark.createDataFrame(changes, "client string, t timestamp, v int")
    e = spark.createDataFrame(events, "client string, t timestamp, id int")
    times = c.select("client", "t").unionAll(e.select("client", "t"))
    heavy = heavy_or_none(times, ["client"], min_rows=300)
    cuts = time_cuts(times, heavy, ["client"], "t").first()["_cuts"]
    assert 20 <= len(cuts) <= 30 and cuts.count(moment(500_000).replace(tzinfo=None)) >= 6
    options = dict(keys=["client"], sequence="t", delete_when="v % 7 = 0", tie_breakers=["v"])
    assert plain(type2_history(c, heavy=heavy, **options).collect()) == plain(type2_history(c, **options).collect())
    versions = type2_history(c, **options).select("client", START, END)
    asof = dict(keys=["client"], at="t", start=START, end=END)
    placed = attach_effective(e, versions, heavy=heavy, **asof)
    assert plain(placed.collect()) == plain(attach_effective(e, versions, **asof).collect())
    # No piece holds more than two pieces' worth: its own rows, and its share of those at a crowded cut.
    moments = sorted(row.t for row in times.where("client = 'hot'").collect())
    held = [0.0] * (len(cuts) + 1)
    for t in moments:
        low, high = bisect_left(cuts, t), bisect_right(cuts, t)
        for piece in range(low, high + 1):
            held[piece] += 1 / (high - low + 1)
    assert max(held) <= 2 * 300


def test_each_side_is_scanned_once(spark, tmp_path):
    events = spark.createDataFrame([("a", moment(i), i) for i in range(100)], "client string, t timestamp, id int")
    versions = spark.createDataFrame([("a", moment(0), None)], f"client string, {START} timestamp, {END} timestamp")
    events.write.parquet(f"{tmp_path}/events")
    versions.write.parquet(f"{tmp_path}/versions")
    stored = [spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}") for df, name in ((events, "events"), (versions, "versions"))]
    heavy = spark.createDataFrame([("a", 10, 100)], "client string, pieces int, rows long")
    placed = attach_effective(*stored, keys=["client"], at="t", start=START, end=END, heavy=heavy)
    assert placed.count() == 100
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<client:string,t:timestamp,id:int>") == 1
    assert plan.count(f"ReadSchema: struct<client:string,{START}:timestamp,{END}:timestamp>") == 1
    assert "Union" in plan and plan.count("Union") == 1


def spoil(folder):
    """Files that cannot be read any more."""
    spoilt = [p for p in folder.rglob("*.parquet")]
    for path in spoilt:
        path.write_bytes(b"no parquet")
    for path in folder.rglob(".*.crc"):
        path.write_bytes(b"")
    return len(spoilt)


def test_only_files_that_may_hold_a_new_identity_are_read(spark, tmp_path):
    settings = Settings(f"{tmp_path}/landing", f"{tmp_path}/lake", buckets=8)
    lake = new_lake(spark, settings)
    for number in range(4):
        days = [{**EVENT, "event_id": f"EVT-{10 * number + k:08d}", "event_timestamp": iso(86400 * (5 * number + k))} for k in range(5)]
        nothing = {**EVENT, "event_id": f"EVT-{10 * number + 9:08d}", "event_timestamp": "never"}
        land(spark, settings, ENGAGEMENT_EVENTS, number, [*days, nothing])
        land(spark, settings, CAMPAIGNS, number, [{**CAMPAIGN, "campaign_id": f"CMP-{number:04d}"}])
        take_in(spark, lake, settings)
    events = lake.arrivals(spark, ENGAGEMENT_EVENTS)
    assert events.count() == 24
    # One repeat from batch 1, one without a day from batch 2, and an identity never seen.
    again = ["EVT-00000012", "EVT-00000029", "EVT-99999999"]
    rows = events.limit(1).drop("event_id").crossJoin(spark.createDataFrame([(i,) for i in again], "event_id string"))
    rows = rows.select(lake.arrivals(spark, ENGAGEMENT_EVENTS).columns)
    index = lake.arrivals_members(ENGAGEMENT_EVENTS)
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    pruned = earlier_copies(rows, index, events, range(4))
    assert sorted(r.event_id for r in pruned.collect()) == again[:2]
    kept = [p for p in (tmp_path / "lake").rglob("batch=*") if p.parent.name == "engagement_events_arrivals"]
    for folder in kept:
        for day in folder.rglob(f"{DAY}=*"):
            if (folder.name, day.name) not in {("batch=1", f"{DAY}=2024-01-08"), ("batch=2", f"{DAY}=__HIVE_DEFAULT_PARTITION__")}:
                assert spoil(day)
    assert sorted(r.event_id for r in pruned.collect()) == again[:2]
    # Without partitions below the batch, batches are skipped.
    campaigns = lake.arrivals(spark, CAMPAIGNS)
    row = spark.createDataFrame(campaigns.where("campaign_id = 'CMP-0002'").collect(), campaigns.schema)
    found = earlier_copies(row, lake.arrivals_members(CAMPAIGNS), campaigns, range(4))
    assert [(r.campaign_id, r.batch) for r in found.collect()] == [("CMP-0002", 2)]


def test_batches_without_an_index_are_read_whole(spark, tmp_path):
    table = spark.createDataFrame([("a", 1, 0), (None, 2, 0), ("c", None, 1)], "k string, p int, batch long")
    index = Members(f"{tmp_path}/members", ("k",), table.schema["p"])
    new = frame(spark, [("z", 0)])
    assert earlier_copies(new, index, table, [0, 1]).count() == 3
    index.record(table.where("batch = 0"), 0)
    assert [r.k for r in earlier_copies(new, index, table, [0, 1]).collect()] == ["c"]
    index.record(table.where("batch = 1"), 1)
    assert earlier_copies(new, index, table, [0, 1]).count() == 0
    assert [r.p for r in earlier_copies(frame(spark, [(None, 0)]), index, table, [0, 1]).collect()] == [2]
    assert [r.k for r in earlier_copies(frame(spark, [("c", 0)]), index, table, [0, 1]).collect()] == ["c"]
    assert earlier_copies(frame(spark, [("c", 0)]), index, table, [0]).count() == 0
    assert earlier_copies(frame(spark, []), index, table, [0, 1]).count() == 0


def test_too_many_partitions_are_named_by_batch(spark, tmp_path, monkeypatch):
    table = spark.createDataFrame([(str(k), k, k // 10) for k in range(30)], "k string, p int, batch long")
    index = Members(f"{tmp_path}/members", ("k",), table.schema["p"])
    for number in range(3):
        index.record(table.where(f"batch = {number}"), number)
    new = frame(spark, [(str(k), 0) for k in (3, 4, 25)])
    assert sorted(r.p for r in earlier_copies(new, index, table, range(3)).collect()) == [3, 4, 25]
    monkeypatch.setattr("lamina.sources.members.MOST_PLACES", 2)
    assert sorted(r.p for r in earlier_copies(new, index, table, range(3)).collect()) == [*range(10), *range(20, 30)]
