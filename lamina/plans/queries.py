"""The registered queries over the driver's tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.feeds import Feed
from lamina.functions.skew import MIN_ROWS, heavy_or_none
from lamina.operators.contract import (
    check_counts,
    column_audit,
    conservation,
    differences,
    evidence,
    identifier_leaks,
    manifest,
    row_counts,
    unknown_references,
)
from lamina.operators.dedup import distinct_keys
from lamina.operators.history import END, START, overlapping_versions, profile_history, type2_history
from lamina.operators.quality import candidates, clean, quarantine
from lamina.operators.star import effective_events, fact_engagement_daily, known_campaign_events
from lamina.plans.agreement import agreement, counted, feed_balance, tallied_tables
from lamina.plans.batch import BatchTables
from lamina.plans.bindings import (
    CAMPAIGNS,
    CLIENT_PROFILES,
    ENGAGEMENT_EVENTS,
    FEEDS,
    SHAPES,
    SOURCES,
    WAVES,
    WIDE_CLIENT_ID,
    land_feed,
    stored_raw,
    table,
)
from lamina.plans.naming import name_tables
from lamina.plans.refresh import FULL, INCREMENTAL, Settings, new_lake, refresh, take_in
from lamina.session import pin_session, shared_folder
from lamina.sources.drift import read_with_rescue
from lamina.sources.lake import Lake
from lamina.sources.landing import set_modified
from lamina.sources.tables import TABLES, Namespace, exists, read_table
from lamina.streaming.ingest import start_ingest

Query = Callable[[SparkSession, str], DataFrame]
FIRST_WAVES, LATER_WAVES = range(0, WAVES // 2), range(WAVES // 2, WAVES)
BUCKETS = 16


# Far below what is heavy in earnest, so that the way for heavy keys is taken on any scale.
SOON_HEAVY, SOON_CROWDED = 40, 2
# Table properties that consumers look up.
PROPERTIES = ("quality", "demo.synthetic", "quality.status", "contains_direct_identifiers")


def batch(spark: SparkSession, sf_dir: str, heavy_min_rows: int = MIN_ROWS, **cutting: int) -> BatchTables:
    raw = {feed.name: stored_raw(spark, sf_dir, feed) for feed in FEEDS}
    return BatchTables(raw, heavy_min_rows, FEEDS, **cutting)


def portable(df: DataFrame) -> DataFrame:
    """Times and days as text, so that two engines and their clients print them alike."""
    shown = {
        "timestamp": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        "timestamp_ntz": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        "date": lambda c: c.cast("string"),
    }
    return df.withColumns(
        {name: shown[kind](F.col(name)) for name, kind in df.dtypes if kind in shown}
    )


def _typed(feed: Feed) -> Query:
    return lambda spark, sf_dir: candidates(stored_raw(spark, sf_dir, feed), feed)


def _clean(feed: Feed) -> Query:
    return lambda spark, sf_dir: batch(spark, sf_dir).clean(feed)


def _quarantine(feed: Feed, payload_fields: tuple[str, ...]) -> Query:
    """The JSON payload is compared by some of its fields: JSON text differs between engines."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fields = {
            f"payload_{name}": F.get_json_object("raw_payload", f"$.{name}")
            for name in payload_fields
        }
        return batch(spark, sf_dir).quarantine(feed).withColumns(fields).drop("raw_payload")

    return run


def rule_failure_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_feed = [
        feed.rules.failure_counts(candidates(stored_raw(spark, sf_dir, feed), feed)) for feed in FEEDS
    ]
    return reduce(DataFrame.unionByName, per_feed)


def history_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changes of a customer: equal dates occur, and status F closes a version."""
    orders = table(spark, sf_dir, "orders")
    return type2_history(
        orders,
        keys=["o_custkey"],
        sequence="o_orderdate",
        delete_when="o_orderstatus = 'F'",
        tie_breakers=["o_orderkey"],
        leave_out=["o_orderstatus", "o_totalprice", "o_orderdate"],
        heavy=heavy_or_none(orders, ["o_custkey"]),
    ).select("o_custkey", "o_orderkey", "o_orderpriority", START, END)


def version_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = batch(spark, sf_dir)
    return overlapping_versions(tables.history, heavy=tables.heavy_clients)


def asof_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = batch(spark, sf_dir)
    events = tables.clean(ENGAGEMENT_EVENTS).select("event_id", "client_id", "event_timestamp")
    return effective_events(events, tables.history, tables.heavy_clients)


def asof_events_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = batch(spark, sf_dir, SOON_HEAVY, slice_seconds=86_400, piece_rows=SOON_CROWDED)
    events = tables.clean(ENGAGEMENT_EVENTS).select("event_id", "client_id", "event_timestamp")
    return effective_events(events, tables.history, tables.heavy_clients)


def known_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = batch(spark, sf_dir)
    events = tables.clean(ENGAGEMENT_EVENTS).select("event_id", "campaign_id")
    return known_campaign_events(events, tables.clean(CAMPAIGNS)).select("event_id", "campaign_id")


def unknown_campaign_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = batch(spark, sf_dir)
    events = tables.raw[ENGAGEMENT_EVENTS.name].select("event_id", "campaign_id")
    return unknown_references(events, tables.clean(CAMPAIGNS), "campaign_id").select(
        "event_id", "campaign_id"
    )


def engagement_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = stored_raw(spark, sf_dir, ENGAGEMENT_EVENTS)
    return column_audit(
        raw,
        distinct=["event_id"],
        nulls=["event_id", "engagement_seconds"],
        prefixes={"client_id": "CL-"},
        equals={
            "campaign_id": "MISSING", "event_timestamp": "not-a-timestamp", "channel": "SOCIAL",
        },
        negatives=["engagement_seconds"],
    )


def _counted(tables: BatchTables) -> dict[str, DataFrame]:
    return {**tables.raw_tables(), **tables.quarantine_tables(), **tables.published_tables()}


def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(_counted(batch(spark, sf_dir)))


def table_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tables must have a row per delivery of the source tables; the others must not be empty."""
    tables = batch(spark, sf_dir)
    floors = {name: 1 for name in (*tables.quarantine_tables(), *tables.published_tables())}
    return check_counts(_counted(tables), deliveries(spark, sf_dir), floors)


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(asset, expected_rows): deliveries of each feed, counted on the source tables alone."""
    counted = []
    for feed in FEEDS:
        source, condition, repeated, _ = SOURCES[feed.name]
        rows = table(spark, sf_dir, source).where(condition)
        total = F.count(F.lit(1)) + F.count_if(F.expr(repeated))
        counted.append(rows.agg(total.alias("expected_rows")).select(F.lit(feed.raw_table).alias("asset"), "expected_rows"))
    return reduce(DataFrame.unionByName, counted)


def contract_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contract that must fail: a wrong expectation, a table that is not there, one too small."""
    raw = batch(spark, sf_dir).raw_tables()
    name = CAMPAIGNS.raw_table
    expected = deliveries(spark, sf_dir).withColumn(
        "expected_rows", F.col("expected_rows") + F.when(F.col("asset") == name, 1).otherwise(0)
    )
    held = {key: df for key, df in raw.items() if key != ENGAGEMENT_EVENTS.raw_table}
    return check_counts(held, expected, {CLIENT_PROFILES.raw_table: 1_000_000_000, "nowhere": 1})


def history_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history does hold client ids; published, it would be a leak."""
    return identifier_leaks(
        {"history": batch(spark, sf_dir).history.select("client_id", "lifecycle_stage")}, WIDE_CLIENT_ID
    )


def open_ended_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history whose versions never end: all but the last of a client overlap."""
    never = F.lit(None).cast("timestamp")
    return overlapping_versions(batch(spark, sf_dir).history.withColumn(END, never))


def unbalanced_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events without the even ones: the feed must come out unbalanced."""
    tables = batch(spark, sf_dir)
    feed = ENGAGEMENT_EVENTS
    lossy = tables.clean(feed).where(F.expr("cast(substring(event_id, 5) AS bigint) % 2 = 1"))
    return conservation(tables.raw[feed.name], lossy, tables.quarantine(feed), feed)


def daily_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw profile feed with times cut to the day, so that many changes tie."""
    day = F.expr("substring(operation_timestamp, 1, 10) || 'T00:00:00Z'")
    cut = F.when(F.col("operation_timestamp") != "not-a-timestamp", day).otherwise(F.col("operation_timestamp"))
    return stored_raw(spark, sf_dir, CLIENT_PROFILES).withColumn("operation_timestamp", cut)


def tied_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_history(clean(daily_changes(spark, sf_dir), CLIENT_PROFILES))


def tied_history_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = clean(daily_changes(spark, sf_dir), CLIENT_PROFILES)
    return profile_history(changes, heavy_or_none(changes, ["client_id"], min_rows=5))


def source_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = stored_raw(spark, sf_dir, CLIENT_PROFILES)
    landed = F.get_json_object("raw_payload", "$.operation_timestamp")
    rows = quarantine(raw, CLIENT_PROFILES, payload_from_source=True)
    return rows.select("client_id", "failed_expectations", landed.alias("payload_operation_timestamp"))


def fact_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of events that come several times: distinct ids are counted, measures count rows."""
    tables = batch(spark, sf_dir)
    events = tables.clean(ENGAGEMENT_EVENTS)
    again = events.where("event_type = 'SENT'")
    return fact_engagement_daily(
        events.unionByName(again), tables.history, tables.clean(CAMPAIGNS), unique_events=False
    )


def promotion_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = batch(spark, sf_dir)
    published = tables.published_tables()
    private = {name: published[name] for name in ("dim_client", "fact_engagement_daily")}
    record = evidence(
        table_contract(spark, sf_dir), identifier_leaks(private, WIDE_CLIENT_ID),
        {**tables.raw_tables(), **published}, "check", "spark_catalog", ("a", "b"),
    )
    pairs = F.transform(
        F.array_sort(F.map_entries("counts")),
        lambda entry: F.format_string("%s=%d", entry["key"], entry["value"]),
    )
    return record.withColumns(
        {
            "counts": F.array_join(pairs, ","),
            "count_failures": F.array_join("count_failures", ","),
            "identifier_leaks": F.array_join("identifier_leaks", ","),
        }
    )


def feed_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = batch(spark, sf_dir)
    return reduce(
        DataFrame.unionByName,
        [
            conservation(tables.raw[feed.name], tables.clean(feed), tables.quarantine(feed), feed)
            for feed in FEEDS
        ],
    )


def leak_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = batch(spark, sf_dir)
    published = tables.published_tables()
    return identifier_leaks(
        {name: published[name] for name in ("dim_client", "fact_engagement_daily")}, WIDE_CLIENT_ID
    )


def table_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(batch(spark, sf_dir).raw)


def _home(spark: SparkSession) -> Settings:
    home = shared_folder(spark, "refresh")
    return Settings(landing=f"{home}/landing", root=f"{home}/lake", buckets=BUCKETS, feeds=FEEDS)


def land_feeds(spark: SparkSession, sf_dir: str, settings: Settings, waves: range) -> None:
    """Land all feeds side by side: a source of few row groups keeps few tasks busy."""
    with ThreadPoolExecutor(len(FEEDS)) as pool:
        landed = [pool.submit(land_feed, spark, sf_dir, feed, settings.folder(feed), waves) for feed in FEEDS]
        for done in landed:
            done.result()


def history_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile history grown from two deliveries, the second with late and repeated changes."""
    settings = _home(spark)
    lake = new_lake(spark, settings)
    for waves in (FIRST_WAVES, LATER_WAVES):
        land_feed(spark, sf_dir, CLIENT_PROFILES, settings.folder(CLIENT_PROFILES), waves)
        take_in(spark, lake, settings)
    return lake.history(spark)


def fact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the deliveries by a full refresh, the others by an incremental one."""
    settings = _home(spark)
    for waves, mode in ((FIRST_WAVES, FULL), (LATER_WAVES, INCREMENTAL)):
        land_feeds(spark, sf_dir, settings, waves)
        lake = refresh(spark, settings, mode)
    return lake.published(spark, "fact_engagement_daily")


#: Hours by which the files of a wave are older than those of the first ones, though they land later.
AGED = {2: 1, 3: 2}
_GROWN: dict[tuple[str, str], tuple[Settings, Lake]] = {}
_WHOLE: dict[tuple[str, str], Lake] = {}


def grown_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake grown step by step, once per application.

    The files that land last are the oldest, so repeats replace the copies that were taken in before.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _GROWN:
        settings = _home(spark)
        now = int(time.time() * 1000)
        for waves in (FIRST_WAVES, LATER_WAVES):
            land_feeds(spark, sf_dir, settings, waves)
            for feed in FEEDS:
                for wave in waves:
                    for shape in SHAPES:
                        folder = f"{settings.folder(feed)}/{shape}/wave={wave}"
                        if exists(spark, folder):
                            set_modified(spark, folder, now - 3_600_000 * AGED.get(wave, 0))
            grown = refresh(spark, settings, INCREMENTAL)
        _GROWN[key] = settings, grown
    return _GROWN[key][1]


def late_lakes(spark: SparkSession, sf_dir: str) -> tuple[Lake, Lake]:
    """The lake grown step by step and one built at once of the same files, for queries that compare the two."""
    key, grown = (spark.sparkContext.applicationId, sf_dir), grown_lake(spark, sf_dir)
    if key not in _WHOLE:
        _WHOLE[key] = refresh(spark, _GROWN[key][0], FULL)
    return grown, _WHOLE[key]


def fact_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grown_lake(spark, sf_dir).published(spark, "fact_engagement_daily")


def dim_client_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grown_lake(spark, sf_dir).published(spark, "dim_client")


def late_files_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table of the lake grown step by step against the one built at once, row by row."""
    lineage = ("_ingest_timestamp", "_source_file", "_source_modified")
    grown, whole = (lake.tables(spark) for lake in late_lakes(spark, sf_dir))
    compared = [
        differences(df.drop(*lineage), whole[name].drop(*lineage)).select(F.lit(name).alias("asset"), "*")
        for name, df in grown.items()
    ]
    return reduce(DataFrame.unionByName, compared)


def tallied_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two lakes by their tallies; rows are read only of parts that differ, and of three untallied tables."""
    return agreement(spark, *late_lakes(spark, sf_dir))


def tallied_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the stored tables that have a tally, without reading one of them."""
    return counted(tallied_tables(spark, grown_lake(spark, sf_dir)))


def tallied_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored feeds balanced with one scan of each raw table."""
    lake = grown_lake(spark, sf_dir)
    return reduce(DataFrame.unionByName, [feed_balance(spark, lake, feed) for feed in FEEDS])


def stored_table_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract on the stored tables of a lake that was refreshed twice."""
    tables = grown_lake(spark, sf_dir).tables(spark)
    counted = {name: tables[name] for name in _counted(batch(spark, sf_dir))}
    floors = {name: 1 for name in counted if not name.endswith("_raw")}
    return check_counts(counted, deliveries(spark, sf_dir), floors)


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names given by the session's configuration: what the catalog says of each table, and its rows."""
    lake = grown_lake(spark, sf_dir)
    unique = uuid.uuid4().hex
    layers = ("bronze", "silver", "gold")
    for layer in layers:
        spark.conf.set(f"lamina.{layer}_schema", f"{layer}_{unique}")
    names = Namespace.from_conf(spark)
    for layer in layers:
        spark.conf.unset(f"lamina.{layer}_schema")
        folder = shared_folder(spark, "schema")
        spark.sql(f"CREATE DATABASE {layer}_{unique} LOCATION '{folder}'")
    rows = []
    for name in name_tables(spark, lake, names):
        full = names.table(TABLES[name].layer, name)
        about = spark.catalog.getTable(full)
        given = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {full}").collect()}
        read = read_table(spark, names, name).agg(F.count(F.lit(1)).alias("row_count"))
        told = [F.lit(given.get(key)).alias(key.replace(".", "_")) for key in PROPERTIES]
        rows.append(
            read.select(
                F.lit(about.namespace[0].removesuffix(f"_{unique}")).alias("schema_name"), F.lit(name).alias("table_name"),
                F.lit(about.description).alias("comment"), *told, "row_count",
            )
        )
    return reduce(DataFrame.unionByName, rows)


def same_output_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History from one batch against history grown by refreshes, row by row."""
    at_once = batch(spark, sf_dir).history
    return differences(at_once, history_incremental(spark, sf_dir).select(at_once.columns))


def drift_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed in five shapes: declared, extra column, text ids, absent and renamed, fractions."""
    home = shared_folder(spark, "drift")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    number = F.col("user_id").cast("string")
    text_id = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("u-"), number)).otherwise(number)
    origin = F.concat(F.lit("o-"), F.col("event_id").cast("string"))
    shapes = (
        lambda df: df,
        lambda df: df.withColumn("origin", origin),
        lambda df: df.withColumn("user_id", text_id),
        lambda df: df.drop("value").withColumnRenamed("event_type", "EVENT_TYPE"),
        lambda df: df.withColumn("user_id", F.col("user_id") + F.when(F.col("event_id") % 2 == 0, 0.5).otherwise(0.0)),
    )
    folders = []
    for number_of, shape in enumerate(shapes):
        folder = f"{home}/shape-{number_of}"
        shape(events.where(F.col("event_id") % 5 == number_of)).write.parquet(folder)
        folders.append(folder)
    return read_with_rescue(spark, folders, events.schema, {})


def landing_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw engagement table after two ingest runs over growing landing files."""
    home = shared_folder(spark, "ingest")
    feed, lake, landing = ENGAGEMENT_EVENTS, Lake(f"{home}/lake"), f"{home}/landing"
    for waves in (FIRST_WAVES, LATER_WAVES):
        land_feed(spark, sf_dir, feed, landing, waves)
        start_ingest(spark, feed, landing, lake).awaitTermination()
    raw = lake.raw(spark, feed)
    traced = F.col("_source_file").contains("/landing/") & F.col("_ingest_timestamp").isNotNull()
    return raw.withColumn("has_lineage", traced).drop("_source_file", "_source_modified", "_ingest_timestamp")


def _registered() -> dict[str, Query]:
    return {
        "profile_candidates_typed": _typed(CLIENT_PROFILES),
        "campaign_candidates_typed": _typed(CAMPAIGNS),
        "engagement_candidates_typed": _typed(ENGAGEMENT_EVENTS),
        "client_profile_changes": _clean(CLIENT_PROFILES),
        "campaigns_clean": _clean(CAMPAIGNS),
        "engagement_events_clean": _clean(ENGAGEMENT_EVENTS),
        "client_profiles_quarantine": _quarantine(
            CLIENT_PROFILES, ("operation_timestamp", "aum_tier", "client_id")
        ),
        "campaigns_quarantine": _quarantine(CAMPAIGNS, ("start_date", "theme", "campaign_id")),
        "engagement_events_quarantine": _quarantine(
            ENGAGEMENT_EVENTS, ("engagement_seconds", "event_id", "synthetic_record")
        ),
        "rule_failure_counts": rule_failure_counts,
        "dedup_lineitem_keys": lambda spark, sf_dir: distinct_keys(
            table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
        ),
        "client_profile_history": lambda spark, sf_dir: batch(spark, sf_dir).history,
        "client_profile_history_incremental": history_incremental,
        "client_profile_history_sliced": lambda spark, sf_dir: batch(
            spark, sf_dir, SOON_HEAVY
        ).history,
        "history_with_ties": history_with_ties,
        "overlapping_versions": version_overlaps,
        "dim_client": lambda spark, sf_dir: batch(spark, sf_dir).dim_client,
        "dim_campaign": lambda spark, sf_dir: batch(spark, sf_dir).dim_campaign,
        "asof_events": asof_events,
        "asof_events_sliced": asof_events_sliced,
        "known_campaign_events": known_events,
        "fact_engagement_daily": lambda spark, sf_dir: batch(spark, sf_dir).fact_engagement_daily,
        "fact_engagement_daily_sliced": lambda spark, sf_dir: batch(
            spark, sf_dir, SOON_HEAVY
        ).fact_engagement_daily,
        "fact_engagement_daily_incremental": fact_incremental,
        "unknown_campaign_events": unknown_campaign_events,
        "column_audit": engagement_audit,
        "profile_changes_rules_first": lambda spark, sf_dir: clean(
            stored_raw(spark, sf_dir, CLIENT_PROFILES), CLIENT_PROFILES, rules_first=True
        ),
        "profiles_quarantine_source_payload": source_payload,
        "profile_history_tied": tied_history,
        "profile_history_tied_sliced": tied_history_sliced,
        "fact_engagement_daily_distinct": fact_distinct,
        "contract_failures": contract_failures,
        "history_identifier_leaks": history_leaks,
        "open_ended_overlaps": open_ended_overlaps,
        "unbalanced_feed": unbalanced_feed,
        "table_row_counts": table_row_counts,
        "table_contract": table_contract,
        "promotion_evidence": promotion_evidence,
        "feed_conservation": feed_conservation,
        "identifier_leaks": leak_scan,
        "table_manifest": table_manifest,
        "same_output_check": same_output_check,
        "drift_rescue": drift_rescue,
        "landing_ingest_incremental": landing_ingest,
        "fact_engagement_daily_late_files": fact_late_files,
        "dim_client_late_files": dim_client_late_files,
        "late_files_agreement": late_files_agreement,
        "tallied_agreement": tallied_agreement,
        "tallied_counts": tallied_counts,
        "tallied_conservation": tallied_conservation,
        "stored_table_contract": stored_table_contract,
        "catalog_tables": catalog_tables,
    }


def _ready(query: Query) -> Query:
    return lambda spark, sf_dir: portable(query(pin_session(spark), sf_dir))


def queries() -> dict[str, Query]:
    return {name: _ready(query) for name, query in _registered().items()}
