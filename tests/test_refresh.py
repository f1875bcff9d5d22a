"""Full and incremental refreshes against the batch tables."""

import random

import pytest
from conftest import CAMPAIGN, EVENT, PROFILE, moment, plain, raw_frame

from lamina.feeds import CAMPAIGNS, CLIENT_PROFILES, ENGAGEMENT_EVENTS, FEEDS
from lamina.operators.contract import ContractViolation, conservation
from lamina.operators.star import fact_engagement_daily
from lamina.plans.batch import BatchTables
from lamina.plans.publish import _fact
from lamina.plans.refresh import FULL, INCREMENTAL, Settings, current_lake, refresh
from lamina.plans.validate import validate
from lamina.sources.lake import Lake
from lamina.sources.tables import Namespace, read_table, save_as_table


def iso(number):
    return moment(number).strftime("%Y-%m-%dT%H:%M:%SZ")


def small_feeds(rng):
    """Rows per feed; identities repeat, some first copies are bad, times tie across clients."""
    profiles = [
        {
            **PROFILE,
            "client_id": f"CL-{rng.choice([1, 1, 2, 3, 4]):06d}",
            "operation": rng.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"]),
            "operation_timestamp": iso(rng.randrange(40) * 3600),
            "lifecycle_stage": rng.choice(["Active", "At Risk", "Unknown"]),
        }
        for _ in range(60)
    ]
    campaigns = [
        {**CAMPAIGN, "campaign_id": f"CMP-{rng.randrange(6):04d}",
         "status": rng.choice(["ACTIVE", "PLANNED", "ARCHIVED"])}
        for _ in range(12)
    ]
    events = [
        {
            **EVENT,
            "event_id": rng.choice([None, *(f"EVT-{rng.randrange(80):08d}" for _ in range(9))]),
            "client_id": f"CL-{rng.choice([1, 1, 2, 3, 9]):06d}",
            "campaign_id": f"CMP-{rng.randrange(8):04d}",
            "event_timestamp": iso(rng.randrange(60) * 3600),
            "event_type": rng.choice(["SENT", "OPENED", "PAGE_VIEW"]),
            "engagement_seconds": rng.choice([None, 3, 4, -1]),
        }
        for _ in range(120)
    ]
    return {CLIENT_PROFILES: profiles, CAMPAIGNS: campaigns, ENGAGEMENT_EVENTS: events}


def land(spark, settings, feed, number, rows):
    schema = feed.landed_schema
    frame = spark.createDataFrame([tuple(r[n] for n in schema.names) for r in rows], schema)
    frame.coalesce(1).write.parquet(f"{settings.folder(feed)}/delivery-{number}")


def compared(tables):
    """Tables without the columns that record when and from where a row was taken in."""
    return {
        name: plain(
            df.drop("_ingest_timestamp", "_source_file", "_source_modified", "_source_system").collect()
        )
        for name, df in tables.items()
    }


@pytest.mark.parametrize("heavy_min_rows", [1_000_000, 5])
def test_incremental_refreshes_equal_one_full_refresh_and_the_batch_tables(
    spark, tmp_path, heavy_min_rows
):
    rng = random.Random(heavy_min_rows)
    feeds = small_feeds(rng)
    grown = Settings(
        f"{tmp_path}/landing", f"{tmp_path}/grown", buckets=3, heavy_min_rows=heavy_min_rows
    )
    for number in range(3):
        for feed, rows in feeds.items():
            land(spark, grown, feed, number, rows[number::3])
        lake = refresh(spark, grown, INCREMENTAL)
        again = fact_engagement_daily(
            lake.clean(spark, ENGAGEMENT_EVENTS), lake.history(spark), lake.clean(spark, CAMPAIGNS)
        )
        assert plain(lake.published(spark, "fact_engagement_daily").collect()) == plain(again.collect())
    step_by_step = compared(lake.tables(spark))
    # Arrival order decides which copy wins, so the batch tables read the stored raw rows.
    raw = {feed.name: lake.raw(spark, feed) for feed in FEEDS}
    batch = BatchTables(raw, heavy_min_rows)
    at_once = {feed.clean_table: batch.clean(feed) for feed in FEEDS}
    at_once |= {"client_profile_history": batch.history}
    at_once |= batch.quarantine_tables() | batch.published_tables()
    at_once |= batch.raw_tables()
    assert step_by_step == compared(at_once)
    assert step_by_step["fact_engagement_daily"] and step_by_step["client_profile_history"]
    counted = fact_engagement_daily(
        batch.clean(ENGAGEMENT_EVENTS), batch.history, batch.clean(CAMPAIGNS), unique_events=False
    )
    assert plain(counted.collect()) == step_by_step["fact_engagement_daily"]
    for feed in FEEDS:
        row = conservation(
            raw[feed.name], lake.clean(spark, feed), lake.quarantined(spark, feed), feed
        ).first()
        assert row.balanced and row.raw_rows == len(feeds[feed]), row
    # A further refresh without new files changes nothing; a full one starts a new generation.
    assert compared(refresh(spark, grown).tables(spark)) == step_by_step
    rebuilt = refresh(spark, grown, FULL)
    assert rebuilt.root != lake.root and current_lake(spark, grown.root) == rebuilt
    assert compared(rebuilt.tables(spark)) == step_by_step


def test_a_late_delete_that_empties_a_bucket_removes_its_versions(spark, tmp_path):
    settings = Settings(f"{tmp_path}/landing", f"{tmp_path}/lake", buckets=50)
    land(spark, settings, CLIENT_PROFILES, 0, [PROFILE, {**PROFILE, "client_id": "CL-000002"}])
    assert refresh(spark, settings).history(spark).count() == 2
    land(spark, settings, CLIENT_PROFILES, 1, [{**PROFILE, "operation": "DELETE"}])
    lake = refresh(spark, settings)
    assert [r.client_id for r in lake.history(spark).collect()] == ["CL-000002"]
    assert lake.published(spark, "dim_client").count() == 1
    assert lake.published(spark, "fact_engagement_daily").count() == 0


def test_a_late_delete_empties_the_days_it_covers(spark, tmp_path):
    settings = Settings(f"{tmp_path}/landing", f"{tmp_path}/lake", buckets=2)
    early, late = {**EVENT}, {**EVENT, "event_id": "EVT-00000002", "event_timestamp": iso(9 * 86400)}
    land(spark, settings, CLIENT_PROFILES, 0, [PROFILE])
    land(spark, settings, CAMPAIGNS, 0, [CAMPAIGN])
    land(spark, settings, ENGAGEMENT_EVENTS, 0, [early, late])

    def days():
        fact = refresh(spark, settings).published(spark, "fact_engagement_daily")
        return sorted(str(row.activity_date) for row in fact.collect())

    assert days() == ["2024-01-02", "2024-01-10"]
    gone = {**PROFILE, "operation": "DELETE", "operation_timestamp": iso(5 * 86400)}
    land(spark, settings, CLIENT_PROFILES, 1, [gone])
    assert days() == ["2024-01-02"]
    land(spark, settings, CLIENT_PROFILES, 2, [{**gone, "operation": "INSERT",
                                                "operation_timestamp": iso(6 * 86400)}])
    assert days() == ["2024-01-02", "2024-01-10"]


@pytest.fixture
def names(spark):
    spark.conf.set("lamina.gold_schema", "named_gold")
    found = Namespace.from_conf(spark)
    spark.conf.unset("lamina.gold_schema")
    schemas = (found.bronze_schema, found.silver_schema, found.gold_schema)
    for schema in schemas:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    yield found
    for schema in schemas:
        spark.sql(f"DROP DATABASE {schema} CASCADE")


def described(spark, table):
    return {row[0]: row[1] for row in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}


def test_settings_follow_the_session(spark):
    spark.conf.set("lamina.landing_path", "/somewhere")
    settings = Settings.from_conf(spark, "/lake")
    spark.conf.unset("lamina.landing_path")
    assert settings.folder(CAMPAIGNS) == "/somewhere/campaigns" and settings.namespace is not None
    assert Settings.from_conf(spark, "/lake").landing == "landing"


def test_tables_carry_comment_and_properties(spark, names):
    assert names.table("gold", "dim_campaign") == "spark_catalog.named_gold.dim_campaign"
    raw = raw_frame(spark, CAMPAIGNS, [{}])
    for _ in range(2):
        save_as_table(BatchTables({CAMPAIGNS.name: raw}).dim_campaign, names, "dim_campaign")
    assert read_table(spark, names, "dim_campaign").count() == 1
    found = described(spark, "named_gold.dim_campaign")
    assert found["Comment"] == "Campaign attributes."
    for part in ("quality=gold", "contains_direct_identifiers=false", "demo.synthetic=true"):
        assert part in found["Table Properties"]


def test_catalog_names_follow_the_current_generation(spark, names, tmp_path):
    settings = Settings(f"{tmp_path}/landing", f"{tmp_path}/lake", buckets=2, namespace=names)
    land(spark, settings, CLIENT_PROFILES, 0, [PROFILE, {**PROFILE, "operation": "UPSERT"}])
    land(spark, settings, CAMPAIGNS, 0, [CAMPAIGN])
    land(spark, settings, ENGAGEMENT_EVENTS, 0, [EVENT, EVENT])
    for mode in (FULL, FULL):
        lake = refresh(spark, settings, mode)
    for name, table in lake.tables(spark).items():
        if table.isEmpty():
            continue
        stored = read_table(spark, names, name)
        assert plain(stored.collect()) == plain(table.collect()), name
        assert stored.columns == table.columns and stored.inputFiles()[0].startswith(
            f"file://{lake.root}/"
        )
    found = described(spark, names.table("silver", "client_profiles_quarantine"))
    assert "quality.status=quarantine" in found["Table Properties"]
    assert read_table(spark, names, "fact_engagement_daily").first().event_count == 1


def test_stored_tables_are_validated(spark, tmp_path):
    settings = Settings(f"{tmp_path}/landing", f"{tmp_path}/lake", buckets=2)
    land(spark, settings, CLIENT_PROFILES, 0, [PROFILE])
    land(spark, settings, CAMPAIGNS, 0, [CAMPAIGN])
    land(spark, settings, ENGAGEMENT_EVENTS, 0, [EVENT])
    lake = refresh(spark, settings)
    record = validate(spark, lake, {"dim_client": 1}, {"campaigns_raw": 1}, "test", f"{tmp_path}/good")
    assert record["status"] == "PASS" and record["catalog"] == "spark_catalog"
    with pytest.raises(ContractViolation):
        validate(spark, lake, {"dim_client": 2}, {}, "test", f"{tmp_path}/bad")


def test_a_refresh_of_days_reads_only_their_partitions(spark, tmp_path):
    lake = Lake(f"{tmp_path}/lake")
    schema = lake.arrivals_schema(ENGAGEMENT_EVENTS)
    spark.createDataFrame([], schema).write.partitionBy("batch", "accepted", "activity_date").parquet(
        lake.arrivals_path(ENGAGEMENT_EVENTS)
    )
    days = spark.sql("SELECT DATE '2024-01-02' AS activity_date")
    plan = _fact(spark, lake, days, 1_000_000)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "event_timestamp" in line]
    assert scans and all("activity_date" in line.split("PartitionFilters")[1] for line in scans), plan
