"""The three feeds: landed columns, typing, identity and quality rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import types as T

from lamina.functions.rules import RuleSet, among, matches

# Feed layouts, word lists, identifier patterns and rule names are the data
# contract with the producers and consumers of the feeds, so they are given, not chosen.
CLIENT_ID_PATTERN = "^CL-[0-9]{6}$"
CAMPAIGN_ID_PATTERN = "^CMP-[0-9]{4}$"
EVENT_ID_PATTERN = "^EVT-[0-9]{8}$"
OPERATIONS = ("INSERT", "UPDATE", "DELETE")
LIFECYCLE_STAGES = ("Prospect", "Active", "At Risk", "Inactive")
CONSENTS = ("granted", "denied")
CHANNELS = ("EMAIL", "WEB", "WEBINAR")
CAMPAIGN_STATUSES = ("PLANNED", "ACTIVE", "COMPLETED")
CHANNEL_EVENTS = {
    "EMAIL": ("SENT", "DELIVERED", "OPENED", "CLICKED", "BOUNCED", "UNSUBSCRIBED"),
    "WEB": ("PAGE_VIEW", "CONTENT_VIEW", "CTA_CLICK"),
    "WEBINAR": ("REGISTERED", "ATTENDED", "WATCH_COMPLETED"),
}
PROFILE_TEXT = (
    "client_id", "source_system", "operation", "operation_timestamp", "profile_change_type",
    "lifecycle_stage", "account_type", "aum_tier", "retirement_horizon", "advice_relationship",
    "email_consent", "personalization_consent", "adobe_segment",
)
CAMPAIGN_TEXT = (
    "campaign_id", "campaign_name", "source_system", "theme", "objective", "primary_channel",
    "start_date", "end_date", "target_audience", "content_topic", "content_format", "status",
)
ENGAGEMENT_TYPES = {
    "event_id": "string", "interaction_id": "string", "sequence_number": "long",
    "event_timestamp": "string", "source_system": "string", "channel": "string",
    "event_type": "string", "campaign_id": "string", "client_id": "string",
    "engagement_seconds": "long", "synthetic_record": "boolean",
}
SYSTEM_TYPES = {
    "_rescued_data": "string", "_ingest_timestamp": "timestamp",
    "_source_file": "string", "_source_modified": "timestamp", "_source_system": "string",
}

NOTHING_RESCUED = "_rescued_data IS NULL OR _rescued_data IN ('', '{}')"


def _unless_delete(predicate: str) -> str:
    return f"operation = 'DELETE' OR ({predicate})"


PROFILE_RULES = RuleSet(
    {
        "profile_has_client_id": matches("client_id", CLIENT_ID_PATTERN),
        "profile_has_valid_operation": among("operation", OPERATIONS),
        "profile_has_valid_sequence": "operation_timestamp IS NOT NULL",
        "profile_has_valid_lifecycle": _unless_delete(among("lifecycle_stage", LIFECYCLE_STAGES)),
        "profile_has_valid_consent": _unless_delete(
            f"{among('email_consent', CONSENTS)} AND {among('personalization_consent', CONSENTS)}"
        ),
        "profile_has_no_rescued_data": NOTHING_RESCUED,
    }
)

CAMPAIGN_RULES = RuleSet(
    {
        "campaign_has_id": matches("campaign_id", CAMPAIGN_ID_PATTERN),
        "campaign_has_name": "campaign_name IS NOT NULL",
        "campaign_has_valid_dates": "end_date >= start_date",
        "campaign_has_valid_channel": among("primary_channel", CHANNELS),
        "campaign_has_valid_status": among("status", CAMPAIGN_STATUSES),
        "campaign_has_no_rescued_data": NOTHING_RESCUED,
    }
)

ENGAGEMENT_RULES = RuleSet(
    {
        "engagement_has_event_id": matches("event_id", EVENT_ID_PATTERN),
        "engagement_has_timestamp": "event_timestamp IS NOT NULL",
        "engagement_has_client": matches("client_id", CLIENT_ID_PATTERN),
        "engagement_has_campaign": matches("campaign_id", CAMPAIGN_ID_PATTERN),
        "engagement_has_valid_channel_event": " OR ".join(
            f"({among('channel', (channel,))} AND {among('event_type', kinds)})"
            for channel, kinds in CHANNEL_EVENTS.items()
        ),
        "engagement_has_nonnegative_duration": (
            "engagement_seconds IS NULL OR engagement_seconds >= 0"
        ),
        "engagement_has_no_rescued_data": NOTHING_RESCUED,
    }
)


@dataclass(frozen=True, eq=False)
class Feed:
    """Everything the generic jobs need to know about one feed."""

    name: str
    source_label: str
    types: dict[str, str]
    identity: tuple[str, ...]
    rules: RuleSet
    quarantine_columns: tuple[str, ...]
    clean_table: str
    timestamps: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()

    def with_patterns(self, patterns: Mapping[str, str], source_label: str | None = None) -> Feed:
        """The feed with other identifier patterns, by contract pattern, and its own source label.

        The contract's patterns are the default; a producer whose keys outgrow their fixed number of
        digits needs wider ones, as cutting the keys would merge different records.
        """
        rules = self.rules.predicates
        for contract, wider in patterns.items():
            rules = {name: text.replace(contract, wider) for name, text in rules.items()}
        return replace(self, rules=RuleSet(rules), source_label=source_label or self.source_label)

    @property
    def landed_schema(self) -> T.StructType:
        return struct(self.types)

    @property
    def raw_schema(self) -> T.StructType:
        return struct({**self.types, **SYSTEM_TYPES})

    @property
    def typed_schema(self) -> T.StructType:
        retyped = dict.fromkeys(self.timestamps, "timestamp") | dict.fromkeys(self.dates, "date")
        return struct({**self.types, **retyped, **SYSTEM_TYPES})

    @property
    def raw_table(self) -> str:
        return f"{self.name}_raw"

    @property
    def quarantine_table(self) -> str:
        return f"{self.name}_quarantine"


def struct(types: dict[str, str]) -> T.StructType:
    struct = T.StructType()
    for name, kind in types.items():
        struct.add(name, kind)
    return struct


def _text(names: Sequence[str]) -> dict[str, str]:
    return {**dict.fromkeys(names, "string"), "synthetic_record": "boolean"}


CLIENT_PROFILES = Feed(
    name="client_profiles",
    source_label="Synthetic profile export",
    types=_text(PROFILE_TEXT),
    identity=("client_id", "operation_timestamp", "operation"),
    timestamps=("operation_timestamp",),
    rules=PROFILE_RULES,
    quarantine_columns=(
        "client_id", "operation", "operation_timestamp", "profile_change_type",
        "lifecycle_stage", "email_consent", "personalization_consent",
    ),
    clean_table="client_profile_changes",
)

CAMPAIGNS = Feed(
    name="campaigns",
    source_label="Synthetic campaign planning export",
    types=_text(CAMPAIGN_TEXT),
    identity=("campaign_id",),
    dates=("start_date", "end_date"),
    rules=CAMPAIGN_RULES,
    quarantine_columns=(
        "campaign_id", "campaign_name", "start_date", "end_date", "primary_channel", "status",
    ),
    clean_table="campaigns_clean",
)

ENGAGEMENT_EVENTS = Feed(
    name="engagement_events",
    source_label="Synthetic owned-channel engagement export",
    types=ENGAGEMENT_TYPES,
    identity=("event_id",),
    timestamps=("event_timestamp",),
    rules=ENGAGEMENT_RULES,
    quarantine_columns=(
        "event_id", "interaction_id", "event_timestamp", "source_system", "channel",
        "event_type", "campaign_id", "client_id", "engagement_seconds",
    ),
    clean_table="engagement_events_clean",
)

FEEDS = (CLIENT_PROFILES, CAMPAIGNS, ENGAGEMENT_EVENTS)
