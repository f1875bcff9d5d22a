"""The registered queries again as plain SQL for an independent engine.

Rules, word lists, patterns, de-duplication, history, star and outcomes are written out here without
the library's operators or constants, so a wrong one there shows. Shared is the shape of the raw
feeds only.
"""

from __future__ import annotations

from lamina.plans.bindings import CAMPAIGNS, CLIENT_PROFILES, DRIFT_JSON, ENGAGEMENT_EVENTS, raw_feed_sql

TIME = "%Y-%m-%d %H:%M:%S.%f"
# The data contract, with identifiers as wide as the source keys need.
UNRESCUED = "_rescued_data IS NULL OR _rescued_data IN ('', '{}')"
RULES = {
    "profiles": {
        "profile_has_client_id": "regexp_matches(client_id, '^CL-[0-9]{6,}$')",
        "profile_has_valid_operation": "operation IN ('INSERT', 'UPDATE', 'DELETE')",
        "profile_has_valid_sequence": "operation_timestamp IS NOT NULL",
        "profile_has_valid_lifecycle": (
            "operation = 'DELETE' OR lifecycle_stage IN ('Prospect', 'Active', 'At Risk', 'Inactive')"
        ),
        "profile_has_valid_consent": (
            "operation = 'DELETE' OR (email_consent IN ('granted', 'denied')"
            " AND personalization_consent IN ('granted', 'denied'))"
        ),
        "profile_has_no_rescued_data": UNRESCUED,
    },
    "campaigns": {
        "campaign_has_id": "regexp_matches(campaign_id, '^CMP-[0-9]{4,}$')",
        "campaign_has_name": "campaign_name IS NOT NULL",
        "campaign_has_valid_dates": "end_date >= start_date",
        "campaign_has_valid_channel": "primary_channel IN ('EMAIL', 'WEB', 'WEBINAR')",
        "campaign_has_valid_status": "status IN ('PLANNED', 'ACTIVE', 'COMPLETED')",
        "campaign_has_no_rescued_data": UNRESCUED,
    },
    "events": {
        "engagement_has_event_id": "regexp_matches(event_id, '^EVT-[0-9]{8,}$')",
        "engagement_has_timestamp": "event_timestamp IS NOT NULL",
        "engagement_has_client": "regexp_matches(client_id, '^CL-[0-9]{6,}$')",
        "engagement_has_campaign": "regexp_matches(campaign_id, '^CMP-[0-9]{4,}$')",
        "engagement_has_valid_channel_event": (
            "(channel = 'EMAIL' AND event_type IN"
            " ('SENT', 'DELIVERED', 'OPENED', 'CLICKED', 'BOUNCED', 'UNSUBSCRIBED'))"
            " OR (channel = 'WEB' AND event_type IN ('PAGE_VIEW', 'CONTENT_VIEW', 'CTA_CLICK'))"
            " OR (channel = 'WEBINAR' AND event_type IN ('REGISTERED', 'ATTENDED', 'WATCH_COMPLETED'))"
        ),
        "engagement_has_nonnegative_duration": "engagement_seconds IS NULL OR engagement_seconds >= 0",
        "engagement_has_no_rescued_data": UNRESCUED,
    },
}
# Which event types each measure counts.
MEASURES = {
    "sent_count": "event_type = 'SENT'",
    "delivered_count": "event_type = 'DELIVERED'",
    "opened_count": "event_type = 'OPENED'",
    "clicked_count": "event_type = 'CLICKED'",
    "bounced_count": "event_type = 'BOUNCED'",
    "unsubscribed_count": "event_type = 'UNSUBSCRIBED'",
    "web_view_count": "event_type IN ('PAGE_VIEW', 'CONTENT_VIEW')",
    "cta_click_count": "event_type = 'CTA_CLICK'",
    "webinar_registered_count": "event_type = 'REGISTERED'",
    "webinar_attended_count": "event_type = 'ATTENDED'",
    "webinar_completed_count": "event_type = 'WATCH_COMPLETED'",
}
IDENTITIES = {
    "profiles": "client_id, operation_timestamp, operation",
    "campaigns": "campaign_id",
    "events": "event_id",
    "tied": "client_id, operation_timestamp, operation",
}
TYPED = {
    "profiles": "TRY_CAST(operation_timestamp AS TIMESTAMP) AS operation_timestamp",
    "tied": "date_trunc('day', TRY_CAST(operation_timestamp AS TIMESTAMP)) AS operation_timestamp",
    "campaigns": "TRY_CAST(start_date AS DATE) AS start_date, TRY_CAST(end_date AS DATE) AS end_date",
    "events": "TRY_CAST(event_timestamp AS TIMESTAMP) AS event_timestamp",
}
RULES["tied"] = RULES["profiles"]
FEED_OF = {"profiles": CLIENT_PROFILES, "campaigns": CAMPAIGNS, "events": ENGAGEMENT_EVENTS}


def _checked(name: str) -> str:
    failed = ", ".join(
        f"CASE WHEN coalesce({p}, false) THEN NULL ELSE '{rule}' END" for rule, p in RULES[name].items()
    )
    return f"SELECT *, concat_ws(', ', {failed}) AS failed_expectations FROM {name}_typed"


def _first(name: str, only: str = "true", order: str = "_source_modified") -> str:
    return (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {IDENTITIES[name]}"
        f" ORDER BY {order}, _source_file) AS copy FROM {name}_checked WHERE {only}) AS ranked"
        " WHERE copy = 1"
    )


def _steps(order: str = "_source_modified") -> dict[str, str]:
    steps = {}
    for name, feed in (FEED_OF | {"tied": CLIENT_PROFILES}).items():
        steps[f"{name}_raw"] = raw_feed_sql(feed)
        kept = ", operation_timestamp AS landed" if feed is CLIENT_PROFILES else ""
        steps[f"{name}_typed"] = f"SELECT * REPLACE ({TYPED[name]}){kept} FROM {name}_raw"
        steps[f"{name}_checked"] = _checked(name)
        steps[f"{name}_first"] = _first(name, order=order)
        steps[f"{name}_clean"] = f"SELECT * FROM {name}_first WHERE failed_expectations = ''"
        steps[f"{name}_bad"] = f"SELECT * FROM {name}_checked WHERE failed_expectations <> ''"
    steps["history"] = _history("profiles_clean")
    steps["placed"] = (
        "SELECT e.*, h.start_at, h.end_at FROM events_clean AS e JOIN history AS h"
        " ON e.client_id = h.client_id AND e.event_timestamp >= h.start_at"
        " AND (h.end_at IS NULL OR e.event_timestamp < h.end_at)"
    )
    steps["fact"] = _fact("placed")
    return steps


def _history(changes: str) -> str:
    ties = ", ".join(f"{name} NULLS FIRST" for name in ("source_system", "operation", *PROFILE_NAMES, "synthetic_record"))
    return (
        "SELECT * FROM (SELECT *, operation_timestamp AS start_at, lead(operation_timestamp) OVER"
        f" (PARTITION BY client_id ORDER BY operation_timestamp, operation = 'DELETE', {ties}) AS end_at"
        f" FROM {changes}) AS spans"
        " WHERE operation <> 'DELETE' AND (end_at IS NULL OR end_at > start_at)"
    )


def _fact(placed: str) -> str:
    measures = ", ".join(f"count(*) FILTER (WHERE {p}) AS {name}" for name, p in MEASURES.items())
    return (
        "SELECT CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS activity_date,"
        f" {_client_key('client_id', 'start_at')} AS client_key,"
        " sha256(campaign_id) AS campaign_key, channel,"
        f" count(DISTINCT event_id) AS event_count, {measures},"
        " CAST(sum(coalesce(engagement_seconds, 0)) AS BIGINT) AS engagement_seconds,"
        f" true AS synthetic_record FROM {placed}"
        " WHERE campaign_id IN (SELECT campaign_id FROM campaigns_clean) GROUP BY 1, 2, 3, 4"
    )


def _client_key(client: str, start: str) -> str:
    return f"sha256({client} || '||' || strftime({start}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z')"


def _time(column: str, alias: str | None = None) -> str:
    return f"strftime({column}, '{TIME}') AS {alias or column}"


def _day(column: str) -> str:
    return f"CAST({column} AS VARCHAR) AS {column}"


PROFILE_NAMES = (
    "profile_change_type", "lifecycle_stage", "account_type", "aum_tier", "retirement_horizon",
    "advice_relationship", "email_consent", "personalization_consent", "adobe_segment",
)
PROFILE_BODY = (
    "profile_change_type, lifecycle_stage, account_type, aum_tier, retirement_horizon,"
    " advice_relationship, email_consent, personalization_consent, adobe_segment"
)
CAMPAIGN_BODY = (
    f"campaign_id, campaign_name, theme, objective, primary_channel, {_day('start_date')},"
    f" {_day('end_date')}, target_audience, content_topic, content_format, status"
)
SYSTEM = f"_rescued_data, {_time('_ingest_timestamp')}, _source_file, {_time('_source_modified')}, _source_system"
PROFILE_ROW = (
    f"client_id, source_system, operation, {_time('operation_timestamp')}, {PROFILE_BODY},"
    f" synthetic_record, {SYSTEM}"
)
CAMPAIGN_ROW = f"{CAMPAIGN_BODY}, source_system, synthetic_record, {SYSTEM}"
EVENT_ROW = (
    f"event_id, interaction_id, sequence_number, {_time('event_timestamp')}, source_system,"
    f" channel, event_type, campaign_id, client_id, engagement_seconds, synthetic_record, {SYSTEM}"
)
HISTORY_ROW = (
    f"client_id, source_system, {_time('operation_timestamp')}, {PROFILE_BODY}, synthetic_record,"
    f" {_time('start_at', '__START_AT')}, {_time('end_at', '__END_AT')}"
)


def _payload(column: str) -> str:
    return f"{column} AS payload_{column}"


def _counted(assets: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{asset}' AS asset, count(*) AS actual_rows FROM {source}"
        for asset, source in assets.items()
    )


COUNTED_ASSETS = {
    "client_profiles_raw": "profiles_raw", "campaigns_raw": "campaigns_raw",
    "engagement_events_raw": "events_raw", "client_profiles_quarantine": "profiles_bad",
    "campaigns_quarantine": "campaigns_bad", "engagement_events_quarantine": "events_bad",
    "dim_client": "history", "dim_campaign": "campaigns_clean", "fact_engagement_daily": "fact",
}


DELIVERED = {
    "client_profiles_raw": (
        "SELECT count(*) + count(*) FILTER (WHERE event_id % 10 = 3) FROM events"
        " WHERE event_type IN ('signup', 'purchase', 'error')"
    ),
    "campaigns_raw": "SELECT count(*) + count(*) FILTER (WHERE p_partkey % 6 = 1) FROM part",
    "engagement_events_raw": (
        "SELECT count(*) + count(*) FILTER (WHERE event_id % 10 = 7) FROM events"
        " WHERE event_type IN ('click', 'view')"
    ),
}


def _contract() -> str:
    """Raw tables have a row per delivery, the others at least one."""
    kind = " ".join(f"WHEN '{asset}' THEN ({sql})" for asset, sql in DELIVERED.items())
    return (
        "SELECT *, CASE WHEN coalesce(expected_rows = actual_rows, true)"
        " AND coalesce(actual_rows >= min_rows, true) THEN 'PASS' ELSE 'FAIL' END AS status"
        f" FROM (SELECT asset, CASE asset {kind} END AS expected_rows,"
        " CASE WHEN asset NOT LIKE '%_raw' THEN 1 END AS min_rows, actual_rows"
        f" FROM ({_counted(COUNTED_ASSETS)}) AS counted) AS compared"
    )


def _contract_failures() -> str:
    """One expectation is off by one, one table is missing, one is too small, one was never there."""
    parts = [
        f"SELECT 'client_profiles_raw' AS asset, ({DELIVERED['client_profiles_raw']}) AS expected_rows,"
        " 1000000000 AS min_rows, (SELECT count(*) FROM profiles_raw) AS actual_rows",
        f"SELECT 'campaigns_raw', ({DELIVERED['campaigns_raw']}) + 1, NULL, (SELECT count(*) FROM campaigns_raw)",
        f"SELECT 'engagement_events_raw', ({DELIVERED['engagement_events_raw']}), NULL, NULL",
        "SELECT 'nowhere', NULL, 1, NULL",
    ]
    return (
        "SELECT *, CASE WHEN actual_rows IS NOT NULL AND coalesce(expected_rows = actual_rows, true)"
        " AND coalesce(actual_rows >= min_rows, true) THEN 'PASS' ELSE 'FAIL' END AS status"
        f" FROM ({' UNION ALL '.join(parts)}) AS compared"
    )


def _rule_failures() -> str:
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE NOT coalesce({p}, false)) AS failed_rows"
        f" FROM {name}_typed"
        for name in FEED_OF
        for rule, p in RULES[name].items()
    )


def _conservation(order: str = "_source_modified") -> str:
    parts = []
    for name, feed in FEED_OF.items():
        total = f"(SELECT count(*) FROM {name}_raw)"
        kept = f"(SELECT count(*) FROM {name}_clean)"
        bad = f"(SELECT count(*) FROM {name}_bad)"
        parts.append(
            f"SELECT '{feed.name}' AS feed, {total} AS raw_rows, {kept} AS clean_rows,"
            f" {bad} AS quarantined_rows, {_suppressed(name, order)} AS suppressed_rows"
        )
    return _balanced(" UNION ALL ".join(parts))


def _suppressed(name: str, order: str = "_source_modified") -> str:
    """Rows that pass the rules though another copy of their identity came first."""
    return (
        f"(SELECT count(*) FROM (SELECT failed_expectations, row_number() OVER (PARTITION BY"
        f" {IDENTITIES[name]} ORDER BY {order}, _source_file) AS copy FROM {name}_checked) AS c"
        " WHERE copy > 1 AND failed_expectations = '')"
    )


def _balanced(feeds: str) -> str:
    return f"SELECT *, raw_rows = clean_rows + quarantined_rows + suppressed_rows AS balanced FROM ({feeds}) AS f"


def _unbalanced() -> str:
    odd = "CAST(substring(event_id, 5) AS BIGINT) % 2 = 1"
    return _balanced(
        "SELECT 'engagement_events' AS feed, (SELECT count(*) FROM events_raw) AS raw_rows,"
        f" (SELECT count(*) FROM events_clean WHERE {odd}) AS clean_rows,"
        f" (SELECT count(*) FROM events_bad) AS quarantined_rows, {_suppressed('events')} AS suppressed_rows"
    )


def _overlaps(ends: str) -> str:
    """Versions for which another of the client begins later but before they end, or at the same time."""
    return (
        f"SELECT DISTINCT a.client_id, {_time('a.start_at', '__START_AT')} FROM history AS a JOIN history AS b"
        f" ON a.client_id = b.client_id AND a.start_at < b.start_at AND ({ends})"
    )


def _leaks() -> str:
    columns = {
        "dim_client": (
            "client_key", "profile_change_type", "lifecycle_stage", "account_type", "aum_tier",
            "retirement_horizon", "advice_relationship", "email_consent",
            "personalization_consent", "adobe_segment",
        ),
        "fact_engagement_daily": ("client_key", "campaign_key", "channel"),
    }
    source = {
        "dim_client": f"(SELECT {_client_key('client_id', 'start_at')} AS client_key,"
        f" {PROFILE_BODY} FROM history) AS published",
        "fact_engagement_daily": "fact",
    }
    return " UNION ALL ".join(
        f"SELECT '{asset}' AS asset, '{column}' AS column_name, false AS forbidden_name,"
        f" count(*) FILTER (WHERE regexp_matches({column}, '^CL-[0-9]{{6,}}$')) AS leaked_values"
        f" FROM {source[asset]}"
        for asset, names in columns.items()
        for column in names
    )


def _manifest() -> str:
    text = (
        "'{\"campaigns\": ' || (SELECT count(*) FROM campaigns_raw) || ', \"client_profiles\": '"
        " || (SELECT count(*) FROM profiles_raw) || ', \"engagement_events\": '"
        " || (SELECT count(*) FROM events_raw) || '}'"
    )
    return f"SELECT t AS counts_json, sha256(t) AS contract_sha256 FROM (SELECT {text} AS t) AS m"


def _evidence() -> str:
    pairs = " || ',' || ".join(
        f"'{asset}=' || (SELECT count(*) FROM {source})"
        for asset, source in sorted(COUNTED_ASSETS.items())
    )
    failures = f"(SELECT coalesce(string_agg(asset, ',' ORDER BY asset), '') FROM ({_contract()}) AS c WHERE status = 'FAIL')"
    leaks = (
        "(SELECT coalesce(string_agg(asset || '.' || column_name, ',' ORDER BY asset, column_name), '')"
        f" FROM ({_leaks()}) AS l WHERE leaked_values > 0 OR forbidden_name)"
    )
    real = " + ".join(f"(SELECT count(*) FROM {t} WHERE NOT synthetic_record)" for t in ("profiles_raw", "campaigns_raw", "events_raw"))
    return (
        "SELECT *, CASE WHEN identifier_leaks = '' THEN 'PASS' ELSE 'FAIL' END AS gold_direct_identifier_check,"
        " CASE WHEN count_failures = '' AND identifier_leaks = '' AND synthetic_data_only THEN 'PASS'"
        f" ELSE 'FAIL' END AS status FROM (SELECT 'check' AS environment, 'spark_catalog' AS catalog, 'a,b' AS schemas,"
        f" {pairs} AS counts, {failures} AS count_failures, {leaks} AS identifier_leaks,"
        f" {real} = 0 AS synthetic_data_only) AS e"
    )


def _column_audit() -> str:
    checks = {
        ("distinct", "event_id"): "count(DISTINCT event_id)",
        ("null", "event_id"): "count(*) - count(event_id)",
        ("null", "engagement_seconds"): "count(*) - count(engagement_seconds)",
        ("prefix", "client_id"): "count(*) FILTER (WHERE starts_with(client_id, 'CL-'))",
        ("equal", "campaign_id"): "count(*) FILTER (WHERE campaign_id = 'MISSING')",
        ("equal", "event_timestamp"): "count(*) FILTER (WHERE event_timestamp = 'not-a-timestamp')",
        ("equal", "channel"): "count(*) FILTER (WHERE channel = 'SOCIAL')",
        ("negative", "engagement_seconds"): "count(*) FILTER (WHERE engagement_seconds < 0)",
    }
    return " UNION ALL ".join(
        f"SELECT '{kind}' AS audit, '{column}' AS column_name, {count} AS value_count FROM events_raw"
        for (kind, column), count in checks.items()
    )


ORDER_SPANS = (
    "SELECT *, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate,"
    " o_orderstatus = 'F', o_orderkey) AS end_at FROM orders"
)


def _finals() -> dict[str, str]:
    payload_time = "strftime(operation_timestamp, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"
    quarantine_tail = f"_source_file, {_time('_ingest_timestamp')}"
    history = f"SELECT {HISTORY_ROW} FROM history"
    asof = (
        f"SELECT event_id, client_id, {_time('event_timestamp')},"
        f" {_time('start_at', '__START_AT')}, {_time('end_at', '__END_AT')} FROM placed"
    )
    return {
        "profile_candidates_typed": f"SELECT {PROFILE_ROW} FROM profiles_typed",
        "campaign_candidates_typed": f"SELECT {CAMPAIGN_ROW} FROM campaigns_typed",
        "engagement_candidates_typed": f"SELECT {EVENT_ROW} FROM events_typed",
        "client_profile_changes": f"SELECT {PROFILE_ROW} FROM profiles_clean",
        "campaigns_clean": f"SELECT {CAMPAIGN_ROW} FROM campaigns_clean",
        "engagement_events_clean": f"SELECT {EVENT_ROW} FROM events_clean",
        "client_profiles_quarantine": (
            f"SELECT client_id, operation, {_time('operation_timestamp')}, profile_change_type,"
            " lifecycle_stage, email_consent, personalization_consent, failed_expectations,"
            f" {payload_time} AS payload_operation_timestamp, {_payload('aum_tier')},"
            f" {_payload('client_id')}, {quarantine_tail} FROM profiles_bad"
        ),
        "campaigns_quarantine": (
            f"SELECT campaign_id, campaign_name, {_day('start_date')}, {_day('end_date')},"
            " primary_channel, status, failed_expectations,"
            f" CAST(start_date AS VARCHAR) AS payload_start_date, {_payload('theme')},"
            f" {_payload('campaign_id')}, {quarantine_tail} FROM campaigns_bad"
        ),
        "engagement_events_quarantine": (
            f"SELECT event_id, interaction_id, {_time('event_timestamp')}, source_system, channel,"
            " event_type, campaign_id, client_id, engagement_seconds, failed_expectations,"
            " CAST(engagement_seconds AS VARCHAR) AS payload_engagement_seconds,"
            f" {_payload('event_id')}, 'true' AS payload_synthetic_record, {quarantine_tail}"
            " FROM events_bad"
        ),
        "rule_failure_counts": _rule_failures(),
        "dedup_lineitem_keys": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
        "client_profile_history": history,
        "client_profile_history_incremental": history,
        "client_profile_history_sliced": history,
        "history_with_ties": (
            f"SELECT o_custkey, o_orderkey, o_orderpriority, {_time('o_orderdate', '__START_AT')},"
            f" {_time('end_at', '__END_AT')} FROM ({ORDER_SPANS}) AS spans"
            " WHERE o_orderstatus <> 'F' AND (end_at IS NULL OR end_at > o_orderdate)"
        ),
        "overlapping_versions": _overlaps("a.end_at IS NULL OR a.end_at > b.start_at"),
        "open_ended_overlaps": _overlaps("true"),
        "profile_history_tied": f"SELECT {HISTORY_ROW} FROM ({_history('tied_clean')}) AS h",
        "profile_history_tied_sliced": f"SELECT {HISTORY_ROW} FROM ({_history('tied_clean')}) AS h",
        "profile_changes_rules_first": (
            f"""SELECT {PROFILE_ROW} FROM ({_first("profiles", "failed_expectations = ''")}) AS good"""
        ),
        "profiles_quarantine_source_payload": (
            "SELECT client_id, failed_expectations, landed AS payload_operation_timestamp FROM profiles_bad"
        ),
        "fact_engagement_daily_distinct": _fact(
            "(SELECT * FROM placed UNION ALL SELECT * FROM placed WHERE event_type = 'SENT') AS placed"
        ),
        "contract_failures": _contract_failures(),
        "unbalanced_feed": _unbalanced(),
        "history_identifier_leaks": (
            "SELECT 'history' AS asset, 'client_id' AS column_name, true AS forbidden_name,"
            " count(*) FILTER (WHERE regexp_matches(client_id, '^CL-[0-9]{6,}$')) AS leaked_values FROM history"
            " UNION ALL SELECT 'history', 'lifecycle_stage', false,"
            " count(*) FILTER (WHERE regexp_matches(lifecycle_stage, '^CL-[0-9]{6,}$')) FROM history"
        ),
        "dim_client": (
            f"SELECT {_client_key('client_id', 'start_at')} AS client_key,"
            f" {_time('start_at', 'valid_from_timestamp')}, {_time('end_at', 'valid_to_timestamp')},"
            f" end_at IS NULL AS is_current_profile, {PROFILE_BODY}, true AS synthetic_record"
            " FROM history"
        ),
        "dim_campaign": (
            f"SELECT sha256(campaign_id) AS campaign_key, {CAMPAIGN_BODY},"
            " true AS synthetic_record FROM campaigns_clean"
        ),
        "asof_events": asof,
        "asof_events_sliced": asof,
        "known_campaign_events": (
            "SELECT event_id, campaign_id FROM events_clean"
            " WHERE campaign_id IN (SELECT campaign_id FROM campaigns_clean)"
        ),
        "fact_engagement_daily": "SELECT * FROM fact",
        "fact_engagement_daily_sliced": "SELECT * FROM fact",
        "fact_engagement_daily_incremental": "SELECT * FROM fact",
        "unknown_campaign_events": (
            "SELECT event_id, campaign_id FROM events_raw AS e WHERE campaign_id IS NOT NULL AND"
            " NOT EXISTS (SELECT 1 FROM campaigns_clean AS c WHERE c.campaign_id = e.campaign_id)"
        ),
        "column_audit": _column_audit(),
        "table_row_counts": _counted(COUNTED_ASSETS),
        "table_contract": _contract(),
        "promotion_evidence": _evidence(),
        "feed_conservation": _conservation(),
        "identifier_leaks": _leaks(),
        "table_manifest": _manifest(),
        "same_output_check": (
            "SELECT (SELECT count(*) FROM history) AS left_rows, (SELECT count(*) FROM history)"
            " AS right_rows, (SELECT count(*) FROM (SELECT * FROM history EXCEPT ALL SELECT * FROM history) AS l)"
            " AS only_left, (SELECT count(*) FROM (SELECT * FROM history EXCEPT ALL SELECT * FROM history) AS r)"
            " AS only_right"
        ),
        "drift_rescue": (
            "SELECT event_id, CASE WHEN event_id % 5 = 2 AND event_id % 3 = 0 THEN NULL ELSE user_id"
            " END AS user_id, event_type, CASE WHEN event_id % 5 = 3 THEN NULL ELSE value END AS"
            " value, CASE WHEN event_id % 5 = 1 THEN '{\"origin\":\"o-' || event_id || '\"}'"
            " WHEN event_id % 5 = 2 AND event_id % 3 = 0 THEN '{\"user_id\":\"u-' || user_id ||"
            " '\"}' WHEN event_id % 5 = 4 AND event_id % 2 = 0 THEN '{\"user_id\":' || user_id || '.5}'"
            " END AS _rescued_data FROM events"
        ),
        "landing_ingest_incremental": (
            "SELECT event_id, interaction_id, sequence_number, event_timestamp, source_system,"
            " channel, event_type, campaign_id, client_id, engagement_seconds, synthetic_record,"
            f" CASE WHEN _rescued_data = '{DRIFT_JSON}' THEN _rescued_data END AS _rescued_data,"
            " _source_system, true AS has_lineage FROM events_raw"
        ),
    }


# What the catalog must say of each table.
CATALOG = {
    "client_profiles_raw": ("bronze", "Client profile changes as they landed.", "profiles_raw"),
    "campaigns_raw": ("bronze", "Campaign plans as they landed.", "campaigns_raw"),
    "engagement_events_raw": ("bronze", "Engagement events as they landed.", "events_raw"),
    "client_profile_changes": ("silver", "Accepted profile changes, one per identity.", "profiles_clean"),
    "campaigns_clean": ("silver", "Accepted campaigns, first arrival per id.", "campaigns_clean"),
    "engagement_events_clean": ("silver", "Accepted events, first arrival per id.", "events_clean"),
    "client_profiles_quarantine": ("silver", "Rejected profile changes.", "profiles_bad"),
    "campaigns_quarantine": ("silver", "Rejected campaigns.", "campaigns_bad"),
    "engagement_events_quarantine": ("silver", "Rejected events.", "events_bad"),
    "client_profile_history": ("silver", "Type 2 versions of client profiles.", "history"),
    "dim_client": ("gold", "Client profile versions without ids.", "history"),
    "dim_campaign": ("gold", "Campaign attributes.", "campaigns_clean"),
    "fact_engagement_daily": ("gold", "Engagement per day, client version, campaign and channel.", "fact"),
}


#: Tables derived from others in full, or by sums, which keep no tally.
UNTALLIED = ("client_profile_history", "dim_campaign", "fact_engagement_daily")


def _finals_of_late_files() -> dict[str, str]:
    """Results when the files that land last are the oldest: of several copies the one sent last wins."""
    told = " UNION ALL ".join(
        f"SELECT '{layer}' AS schema_name, '{name}' AS table_name, '{comment}' AS comment, '{layer}' AS quality,"
        " 'true' AS demo_synthetic,"
        f" {chr(39) + 'quarantine' + chr(39) if name.endswith('_quarantine') else 'NULL'} AS quality_status,"
        f" {chr(39) + 'false' + chr(39) if layer == 'gold' else 'NULL'} AS contains_direct_identifiers,"
        f" (SELECT count(*) FROM {source}) AS row_count"
        for name, (layer, comment, source) in CATALOG.items()
    )
    agreement = " UNION ALL ".join(
        f"SELECT '{name}' AS asset, (SELECT count(*) FROM {source}) AS left_rows,"
        f" (SELECT count(*) FROM {source}) AS right_rows, 0 AS only_left, 0 AS only_right"
        for name, (_, _, source) in CATALOG.items()
    )
    return {
        "fact_engagement_daily_late_files": "SELECT * FROM fact",
        "dim_client_late_files": _finals()["dim_client"],
        "late_files_agreement": agreement,
        "tallied_agreement": agreement,
        "tallied_counts": " UNION ALL ".join(
            f"SELECT '{name}' AS asset, (SELECT count(*) FROM {source}) AS actual_rows"
            for name, (_, _, source) in CATALOG.items() if name not in UNTALLIED
        ),
        "tallied_conservation": _conservation("_source_modified DESC"),
        "stored_table_contract": _contract(),
        "catalog_tables": told,
    }


def oracle_sql() -> dict[str, str]:
    known = {}
    for steps, finals in ((_steps(), _finals()), (_steps("_source_modified DESC"), _finals_of_late_files())):
        prefix = "WITH " + ", ".join(f"{name} AS ({sql})" for name, sql in steps.items())
        known |= {name: f"{prefix} {final}" for name, final in finals.items()}
    return known
