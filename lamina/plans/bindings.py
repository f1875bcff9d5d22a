"""The driver's tables shaped as the three feeds, defects and repeated deliveries included.

Each feed covers its whole source table: signup, purchase and error events are profile changes,
click and view events are engagement, every part is a campaign. The column definitions are SQL
text that Spark and the checking engine read alike, apart from the few dialect words in braces.
Remainders of the key plant a defect for every rule; rows with a certain last digit are delivered
a second time, later and changed, so that the first copy has to win.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.feeds import (
    CAMPAIGN_ID_PATTERN,
    CAMPAIGNS as CONTRACT_CAMPAIGNS,
    CLIENT_ID_PATTERN,
    CLIENT_PROFILES as CONTRACT_PROFILES,
    ENGAGEMENT_EVENTS as CONTRACT_EVENTS,
    EVENT_ID_PATTERN,
    Feed,
)
from lamina.session import shared_folder
from lamina.sources.tables import exists

DRIFT_COLUMN = "unexpected_source_field"
DRIFT_VALUE = "drift"
DRIFT_JSON = f'{{"{DRIFT_COLUMN}":"{DRIFT_VALUE}"}}'
SPARK_WORDS = {
    "stamp": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX\")",
    "k": "get_json_object(props, '$.k')",
    "drift": DRIFT_JSON,
    "empty": "{}",
}
CHECK_WORDS = {
    "stamp": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'",
    "k": "json_extract_string(props, '$.k')",
    "drift": DRIFT_JSON,
    "empty": "{}",
}

# Source keys may have more digits than the contract's ids; they are kept whole.
WIDE_CLIENT_ID = "^CL-[0-9]{6,}$"
WIDE_PATTERNS = {
    CLIENT_ID_PATTERN: WIDE_CLIENT_ID,
    CAMPAIGN_ID_PATTERN: "^CMP-[0-9]{4,}$",
    EVENT_ID_PATTERN: "^EVT-[0-9]{8,}$",
}
CLIENT_PROFILES = CONTRACT_PROFILES.with_patterns(WIDE_PATTERNS)
CAMPAIGNS = CONTRACT_CAMPAIGNS.with_patterns(WIDE_PATTERNS)
ENGAGEMENT_EVENTS = CONTRACT_EVENTS.with_patterns(WIDE_PATTERNS)
FEEDS = (CLIENT_PROFILES, CAMPAIGNS, ENGAGEMENT_EVENTS)


def _padded(number: str, digits: int) -> str:
    """Filled up with zeros to so many digits; longer numbers stay whole (lpad would cut them)."""
    return f"lpad({number}, CAST(greatest({digits}, length({number})) AS INT), '0')"


PROFILE_SOURCE = "event_type IN ('signup', 'purchase', 'error')"
PROFILE_REPEATED = "event_id % 10 = 3"
PROFILE_COLUMNS = {
    "client_id": (
        "CASE WHEN event_id % 97 = 0 THEN NULL"
        " WHEN event_id % 101 = 0 THEN 'CLIENT-' || CAST(user_id AS STRING)"
        f" ELSE 'CL-' || {_padded('CAST(user_id AS STRING)', 6)} END"
    ),
    "source_system": "'profile export'",
    "operation": (
        "CASE WHEN event_id % 103 = 0 THEN 'UPSERT' WHEN event_type = 'signup' THEN 'INSERT'"
        " WHEN event_type = 'purchase' THEN 'UPDATE' ELSE 'DELETE' END"
    ),
    "operation_timestamp": (
        "CASE WHEN event_id % 107 = 0 THEN 'not-a-timestamp' WHEN event_id % 109 = 0 THEN NULL"
        " ELSE {stamp} END"
    ),
    "profile_change_type": (
        "CASE WHEN delivery = 1 THEN 'REDELIVERED' WHEN event_type = 'signup' THEN"
        " 'INITIAL_PROFILE' WHEN event_id % 2 = 0 THEN 'LIFECYCLE_CHANGE'"
        " ELSE 'ADVICE_RELATIONSHIP_CHANGE' END"
    ),
    "lifecycle_stage": (
        "CASE WHEN delivery = 1 THEN 'Active' WHEN value < 1 THEN 'Unknown'"
        " WHEN value < 20 THEN 'Prospect' WHEN value < 60 THEN 'Active'"
        " WHEN value < 100 THEN 'At Risk' ELSE 'Inactive' END"
    ),
    "account_type": "CASE WHEN user_id % 3 = 0 THEN 'IRA' ELSE 'Brokerage' END",
    "aum_tier": "CASE WHEN value < 50 THEN 'Emerging' ELSE 'Established' END",
    "retirement_horizon": "CASE WHEN user_id % 2 = 0 THEN '0-5 years' ELSE '20+ years' END",
    "advice_relationship": "CASE WHEN event_id % 3 = 0 THEN 'Human Advice' ELSE 'Self-Directed' END",
    "email_consent": (
        "CASE WHEN delivery = 0 AND event_id % 61 = 0 THEN 'pending'"
        " WHEN event_id % 5 = 0 THEN 'denied' ELSE 'granted' END"
    ),
    "personalization_consent": (
        "CASE WHEN delivery = 0 AND event_id % 67 = 0 THEN NULL"
        " WHEN event_id % 7 = 0 THEN 'denied' ELSE 'granted' END"
    ),
    "adobe_segment": "'segment-' || CAST(user_id % 8 AS STRING)",
    "synthetic_record": "true",
    "_rescued_data": (
        "CASE WHEN event_id % 71 = 0 THEN '{drift}' WHEN event_id % 2 = 0 THEN '{empty}'"
        " ELSE NULL END"
    ),
    "_ingest_timestamp": "CAST(ts AS TIMESTAMP) + INTERVAL '1' DAY * (1 + delivery)",
    "_source_modified": "CAST(ts AS TIMESTAMP) + INTERVAL '1' HOUR * (1 + delivery)",
    "_source_file": "'client_profiles/part-' || CAST(event_id % 4 AS STRING)",
    "_source_system": f"'{CLIENT_PROFILES.source_label}'",
}

ENGAGEMENT_SOURCE = "event_type IN ('click', 'view')"
ENGAGEMENT_REPEATED = "event_id % 10 = 7"
ENGAGEMENT_COLUMNS = {
    "event_id": (
        "CASE WHEN event_id % 83 = 0 THEN NULL"
        f" ELSE 'EVT-' || {_padded('CAST(event_id AS STRING)', 8)} END"
    ),
    "interaction_id": "'INT-' || CAST(event_id % 1000 AS STRING)",
    "sequence_number": "event_id % 5 + 1",
    "event_timestamp": (
        "CASE WHEN event_id % 79 = 0 THEN 'not-a-timestamp' ELSE {stamp} END"
    ),
    "source_system": "CASE WHEN delivery = 1 THEN 'replay' ELSE 'channel export' END",
    "channel": (
        "CASE WHEN event_id % 73 = 0 THEN 'SOCIAL' WHEN event_id % 4 = 3 THEN 'WEBINAR'"
        " WHEN event_id % 4 = 2 THEN 'WEB' ELSE 'EMAIL' END"
    ),
    "event_type": (
        "CASE WHEN event_id % 4 = 3 THEN CASE event_id % 3 WHEN 0 THEN 'REGISTERED'"
        " WHEN 1 THEN 'ATTENDED' ELSE 'WATCH_COMPLETED' END"
        " WHEN event_id % 4 = 2 THEN CASE event_id % 3 WHEN 0 THEN 'PAGE_VIEW'"
        " WHEN 1 THEN 'CONTENT_VIEW' ELSE 'CTA_CLICK' END"
        " WHEN event_type = 'click' THEN CASE event_id % 3 WHEN 0 THEN 'CLICKED'"
        " WHEN 1 THEN 'BOUNCED' ELSE 'UNSUBSCRIBED' END"
        " ELSE CASE event_id % 3 WHEN 0 THEN 'SENT' WHEN 1 THEN 'DELIVERED' ELSE 'OPENED' END END"
    ),
    "campaign_id": (
        f"CASE WHEN event_id % 53 = 0 THEN 'MISSING' ELSE 'CMP-' || {_padded('{k}', 4)} END"
    ),
    "client_id": (
        "CASE WHEN event_id % 59 = 0 THEN 'UNKNOWN'"
        f" ELSE 'CL-' || {_padded('CAST(user_id AS STRING)', 6)} END"
    ),
    "engagement_seconds": (
        "CASE WHEN delivery = 0 AND event_id % 47 = 0 THEN -30 WHEN event_id % 9 = 0 THEN NULL"
        " ELSE CAST(floor(value) AS BIGINT) END"
    ),
    "synthetic_record": "true",
    "_rescued_data": (
        "CASE WHEN event_id % 43 = 0 THEN '{drift}' WHEN event_id % 2 = 0 THEN '{empty}'"
        " ELSE NULL END"
    ),
    "_ingest_timestamp": "CAST(ts AS TIMESTAMP) + INTERVAL '1' DAY * (1 + delivery)",
    "_source_modified": "CAST(ts AS TIMESTAMP) + INTERVAL '1' HOUR * (1 + delivery)",
    "_source_file": "'engagement_events/part-' || CAST(event_id % 4 AS STRING)",
    "_source_system": f"'{ENGAGEMENT_EVENTS.source_label}'",
}

CAMPAIGN_SOURCE = "true"
CAMPAIGN_REPEATED = "p_partkey % 6 = 1"
_START = "DATE '2024-01-01' + p_size"
CAMPAIGN_COLUMNS = {
    "campaign_id": (
        "CASE WHEN p_partkey % 31 = 0 THEN NULL"
        f" ELSE 'CMP-' || {_padded('CAST(p_partkey AS STRING)', 4)} END"
    ),
    "campaign_name": (
        "CASE WHEN delivery = 0 AND p_partkey % 17 = 0 THEN NULL WHEN delivery = 1"
        " THEN 'renamed ' || p_name ELSE p_name END"
    ),
    "source_system": "'campaign planning'",
    "theme": "p_type",
    "objective": "p_brand",
    "primary_channel": (
        "CASE WHEN p_partkey % 19 = 0 THEN 'FAX' WHEN p_partkey % 3 = 0 THEN 'EMAIL'"
        " WHEN p_partkey % 3 = 1 THEN 'WEB' ELSE 'WEBINAR' END"
    ),
    "start_date": (
        f"CASE WHEN p_partkey % 37 = 0 THEN 'not-a-date' ELSE CAST({_START} AS STRING) END"
    ),
    "end_date": (
        f"CASE WHEN p_partkey % 29 = 0 THEN CAST({_START} - 10 AS STRING)"
        f" WHEN p_partkey % 41 = 0 THEN NULL ELSE CAST({_START} + 45 AS STRING) END"
    ),
    "target_audience": "CASE WHEN p_size > 25 THEN 'wide' ELSE 'narrow' END",
    "content_topic": "p_type",
    "content_format": "CASE WHEN p_partkey % 2 = 0 THEN 'Article' ELSE 'Checklist' END",
    "status": (
        "CASE WHEN p_size > 45 THEN 'ARCHIVED' WHEN p_size > 30 THEN 'PLANNED'"
        " WHEN p_size > 15 THEN 'ACTIVE' ELSE 'COMPLETED' END"
    ),
    "synthetic_record": "true",
    "_rescued_data": "CASE WHEN p_partkey % 23 = 0 THEN '{drift}' ELSE NULL END",
    "_ingest_timestamp": (
        "CAST(TIMESTAMP '2024-01-01 00:00:00' AS TIMESTAMP)"
        " + INTERVAL '1' SECOND * p_partkey + INTERVAL '3650' DAY * delivery"
    ),
    "_source_modified": (
        "CAST(TIMESTAMP '2024-01-01 00:00:00' AS TIMESTAMP) + INTERVAL '1' DAY * delivery"
    ),
    "_source_file": "'campaigns/part-' || CAST(p_partkey % 4 AS STRING)",
    "_source_system": f"'{CAMPAIGNS.source_label}'",
}

SOURCES = {
    CLIENT_PROFILES.name: ("events", PROFILE_SOURCE, PROFILE_REPEATED, PROFILE_COLUMNS),
    ENGAGEMENT_EVENTS.name: ("events", ENGAGEMENT_SOURCE, ENGAGEMENT_REPEATED, ENGAGEMENT_COLUMNS),
    CAMPAIGNS.name: ("part", CAMPAIGN_SOURCE, CAMPAIGN_REPEATED, CAMPAIGN_COLUMNS),
}
SOURCE_KEY = {"events": "event_id", "part": "p_partkey"}
# Rows that repeat an identity delivered before.
REPEATS = {"events": "delivery = 1", "part": "delivery = 1"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_feed(spark: SparkSession, sf_dir: str, feed: Feed, extra: Mapping[str, str] = {}) -> DataFrame:
    """The raw table of a feed; ``extra`` adds columns over the source row and ``delivery``."""
    source, condition, repeated, columns = SOURCES[feed.name]
    deliveries = F.when(F.expr(repeated), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = table(spark, sf_dir, source).where(condition).select(
        "*", F.explode(deliveries).alias("delivery")
    )
    fitted = [
        F.expr(columns[field.name].format(**SPARK_WORDS)).cast(field.dataType).alias(field.name)
        for field in feed.raw_schema
    ]
    return rows.select(*fitted, *(F.expr(text).alias(name) for name, text in extra.items()))


_STORED: dict[tuple[str, str, str], str] = {}


def stored_raw(spark: SparkSession, sf_dir: str, feed: Feed) -> DataFrame:
    """The raw feed as a stored table, written once per application, as ingest would leave it.

    Later steps then prune columns and push filters into the scan, instead of working the
    definitions above into every rule.
    """
    key = (spark.sparkContext.applicationId, sf_dir, feed.name)
    if key not in _STORED or not exists(spark, _STORED[key]):
        folder = f"{shared_folder(spark, 'raw')}/{feed.name}"
        raw_feed(spark, sf_dir, feed).write.parquet(folder)
        _STORED[key] = folder
    return spark.read.schema(feed.raw_schema).parquet(_STORED[key])


def raw_feed_sql(feed: Feed) -> str:
    """The same rows for the checking engine."""
    source, condition, repeated, columns = SOURCES[feed.name]
    listed = ", ".join(f"{text.format(**CHECK_WORDS)} AS {name}" for name, text in columns.items())
    return (
        f"SELECT {listed} FROM (SELECT *, 0 AS delivery FROM {source} WHERE {condition}"
        f" UNION ALL SELECT *, 1 AS delivery FROM {source} WHERE {condition} AND {repeated}) AS src"
    )


WAVES = 4
SHAPES = ("plain", "drift")


def land_feed(spark: SparkSession, sf_dir: str, feed: Feed, folder: str, waves: range) -> None:
    """Write the feed as landed files, in waves of arrival.

    First deliveries are spread over the early waves regardless of their time, so changes arrive
    out of order; repeats come in the last wave. Rows with rescued data land in files of their own
    that have the undeclared column.
    """
    source = SOURCES[feed.name][0]
    early = f"{SOURCE_KEY[source]} % {WAVES - 1}"
    wave = f"CASE WHEN {REPEATS[source]} THEN {WAVES - 1} ELSE {early} END"
    raw = raw_feed(spark, sf_dir, feed, {"wave": f"CAST({wave} AS INT)"})
    drifted = F.coalesce(F.col("_rescued_data") == DRIFT_JSON, F.lit(False))
    landed = feed.landed_schema.names
    due = raw.where(F.col("wave").isin(list(waves)))
    shapes = {
        "plain": due.where(~drifted).select(*landed, "wave"),
        "drift": due.where(drifted).select(*landed, F.lit(DRIFT_VALUE).alias(DRIFT_COLUMN), "wave"),
    }
    for shape, rows in shapes.items():
        rows.write.mode("append").partitionBy("wave").parquet(f"{folder}/{shape}")
