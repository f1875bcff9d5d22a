import json

import pytest
from conftest import raw_frame

from lamina.feeds import CAMPAIGNS, CLIENT_PROFILES, ENGAGEMENT_EVENTS, FEEDS
from lamina.operators.quality import candidates, clean, quarantine

# One row per way to break a rule, and the rule that has to name it.
BROKEN = [
    (CLIENT_PROFILES, {"client_id": None}, "profile_has_client_id"),
    (CLIENT_PROFILES, {"client_id": "CLIENT-7"}, "profile_has_client_id"),
    (CLIENT_PROFILES, {"operation": "UPSERT"}, "profile_has_valid_operation"),
    (CLIENT_PROFILES, {"operation_timestamp": "not-a-timestamp"}, "profile_has_valid_sequence"),
    (CLIENT_PROFILES, {"operation_timestamp": None}, "profile_has_valid_sequence"),
    (CLIENT_PROFILES, {"lifecycle_stage": "Dormant"}, "profile_has_valid_lifecycle"),
    (CLIENT_PROFILES, {"lifecycle_stage": None}, "profile_has_valid_lifecycle"),
    (CLIENT_PROFILES, {"email_consent": "pending"}, "profile_has_valid_consent"),
    (CLIENT_PROFILES, {"personalization_consent": None}, "profile_has_valid_consent"),
    (CLIENT_PROFILES, {"_rescued_data": '{"x":"1"}'}, "profile_has_no_rescued_data"),
    (CAMPAIGNS, {"campaign_id": None}, "campaign_has_id"),
    (CAMPAIGNS, {"campaign_id": "CMP-12345"}, "campaign_has_id"),
    (CAMPAIGNS, {"campaign_name": None}, "campaign_has_name"),
    (CAMPAIGNS, {"end_date": "2023-01-01"}, "campaign_has_valid_dates"),
    (CAMPAIGNS, {"end_date": None}, "campaign_has_valid_dates"),
    (CAMPAIGNS, {"start_date": "soon"}, "campaign_has_valid_dates"),
    (CAMPAIGNS, {"primary_channel": "FAX"}, "campaign_has_valid_channel"),
    (CAMPAIGNS, {"status": "ARCHIVED"}, "campaign_has_valid_status"),
    (CAMPAIGNS, {"_rescued_data": '{"x":"1"}'}, "campaign_has_no_rescued_data"),
    (ENGAGEMENT_EVENTS, {"event_id": None}, "engagement_has_event_id"),
    (ENGAGEMENT_EVENTS, {"event_timestamp": "not-a-timestamp"}, "engagement_has_timestamp"),
    (ENGAGEMENT_EVENTS, {"client_id": "UNKNOWN"}, "engagement_has_client"),
    (ENGAGEMENT_EVENTS, {"campaign_id": "MISSING"}, "engagement_has_campaign"),
    (ENGAGEMENT_EVENTS, {"channel": "SOCIAL"}, "engagement_has_valid_channel_event"),
    (ENGAGEMENT_EVENTS, {"channel": "WEB"}, "engagement_has_valid_channel_event"),
    (ENGAGEMENT_EVENTS, {"engagement_seconds": -30}, "engagement_has_nonnegative_duration"),
    (ENGAGEMENT_EVENTS, {"_rescued_data": '{"x":"1"}'}, "engagement_has_no_rescued_data"),
]
FINE = {
    CLIENT_PROFILES.name: [
        {}, {"_rescued_data": ""}, {"_rescued_data": "{}"}, {"operation": "UPDATE"},
        {"operation": "DELETE", "lifecycle_stage": None, "email_consent": None},
    ],
    CAMPAIGNS.name: [{}, {"end_date": "2024-01-01"}, {"primary_channel": "WEBINAR"}],
    ENGAGEMENT_EVENTS.name: [
        {}, {"engagement_seconds": 0}, {"engagement_seconds": 5},
        {"channel": "WEBINAR", "event_type": "ATTENDED"},
    ],
}


def test_every_rule_is_broken_once():
    assert {rule for _, _, rule in BROKEN} == {rule for feed in FEEDS for rule in feed.rules}
    assert sum(len(list(feed.rules)) for feed in FEEDS) == 19


@pytest.mark.parametrize("feed", FEEDS, ids=lambda feed: feed.name)
def test_quarantine_names_the_broken_rule_and_is_the_exact_inverse(spark, feed):
    broken = [(row, rule) for owner, row, rule in BROKEN if owner == feed]
    tagged = [{**row, "_source_file": str(i)} for i, (row, _) in enumerate(broken)]
    fine = [{**row, "_source_file": f"fine {i}"} for i, row in enumerate(FINE[feed.name])]
    raw = raw_frame(spark, feed, tagged + fine)
    bad = {r._source_file: r.failed_expectations for r in quarantine(raw, feed).collect()}
    assert bad == {str(i): rule for i, (_, rule) in enumerate(broken)}
    good = candidates(raw, feed).where(feed.rules.accepted())
    assert {r._source_file for r in good.collect()} == {row["_source_file"] for row in fine}
    counted = {
        r.rule: r.failed_rows for r in feed.rules.failure_counts(candidates(raw, feed)).collect()
    }
    assert counted == {
        rule: sum(1 for _, name in broken if name == rule) for rule in feed.rules
    }


def test_failures_are_listed_in_declaration_order(spark):
    raw = raw_frame(
        spark, CLIENT_PROFILES,
        [{"client_id": None, "operation": "UPSERT", "operation_timestamp": "x",
          "email_consent": "pending"}],
    )
    row = quarantine(raw, CLIENT_PROFILES).first()
    assert row.failed_expectations == (
        "profile_has_client_id, profile_has_valid_operation, profile_has_valid_sequence,"
        " profile_has_valid_consent"
    )


def test_payload_is_typed_by_default_and_keeps_source_text_on_request(spark):
    raw = raw_frame(spark, ENGAGEMENT_EVENTS, [{"event_timestamp": "not-a-timestamp"}])
    typed = json.loads(quarantine(raw, ENGAGEMENT_EVENTS).first().raw_payload)
    source = json.loads(
        quarantine(raw, ENGAGEMENT_EVENTS, payload_from_source=True).first().raw_payload
    )
    assert "event_timestamp" not in typed and "engagement_seconds" not in typed
    assert source["event_timestamp"] == "not-a-timestamp"
    assert not any(name.startswith("_") for name in typed | source)


def test_bad_first_copy_suppresses_a_later_good_one_unless_rules_go_first(spark):
    raw = raw_frame(
        spark, ENGAGEMENT_EVENTS,
        [{"engagement_seconds": -1, "_source_file": "a"},
         {"engagement_seconds": 4, "_source_file": "b"},
         {"engagement_seconds": 5, "_source_file": "c"}],
    )
    assert clean(raw, ENGAGEMENT_EVENTS).count() == 0
    assert clean(raw, ENGAGEMENT_EVENTS, rules_first=True).first().engagement_seconds == 4
    assert quarantine(raw, ENGAGEMENT_EVENTS).count() == 1


def test_the_typed_projection_serves_streams_too(spark, tmp_path):
    raw_frame(spark, CAMPAIGNS, [{}]).write.parquet(f"{tmp_path}/raw")
    stream = spark.readStream.schema(CAMPAIGNS.raw_schema).parquet(f"{tmp_path}/raw")
    assert candidates(stream, CAMPAIGNS).isStreaming
    assert candidates(stream, CAMPAIGNS).schema == CAMPAIGNS.typed_schema
