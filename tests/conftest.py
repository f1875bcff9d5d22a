import os
import sys
from datetime import datetime, timezone

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lamina.session import pin_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield pin_session(session)
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def moment(number: int) -> datetime:
    """A time that differs by ``number`` seconds from a fixed one."""
    return datetime.fromtimestamp(1_704_067_200 + number, tz=timezone.utc)


def plain(rows) -> list[tuple]:
    return sorted((tuple(row) for row in rows), key=repr)


PROFILE = {
    "client_id": "CL-000001", "source_system": "s", "operation": "INSERT",
    "operation_timestamp": "2024-01-01T00:00:00Z", "profile_change_type": "INITIAL_PROFILE",
    "lifecycle_stage": "Prospect", "account_type": "IRA", "aum_tier": "Emerging",
    "retirement_horizon": "20+ years", "advice_relationship": "Self-Directed",
    "email_consent": "granted", "personalization_consent": "denied", "adobe_segment": "x",
    "synthetic_record": True,
}
CAMPAIGN = {
    "campaign_id": "CMP-0001", "campaign_name": "n", "source_system": "s", "theme": "t",
    "objective": "o", "primary_channel": "EMAIL", "start_date": "2024-01-01",
    "end_date": "2024-02-01", "target_audience": "a", "content_topic": "c",
    "content_format": "Article", "status": "ACTIVE", "synthetic_record": True,
}
EVENT = {
    "event_id": "EVT-00000001", "interaction_id": "i", "sequence_number": 1,
    "event_timestamp": "2024-01-02T00:00:00Z", "source_system": "s", "channel": "EMAIL",
    "event_type": "SENT", "campaign_id": "CMP-0001", "client_id": "CL-000001",
    "engagement_seconds": None, "synthetic_record": True,
}
SYSTEM = {
    "_rescued_data": None, "_ingest_timestamp": at("2024-06-01T00:00:00"), "_source_file": "f",
    "_source_modified": at("2024-05-31T00:00:00"),
    "_source_system": "label",
}


def raw_frame(spark, feed, rows):
    """Raw rows from partial dictionaries over a valid row of the feed."""
    base = {"client_profiles": PROFILE, "campaigns": CAMPAIGN, "engagement_events": EVENT}[feed.name]
    full = [{**base, **SYSTEM, **row} for row in rows]
    names = feed.raw_schema.names
    return spark.createDataFrame([tuple(row[n] for n in names) for row in full], feed.raw_schema)
