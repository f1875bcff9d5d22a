"""The published star: two dimensions and one daily fact."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions.keys import campaign_key, version_key
from lamina.functions.typing import activity_date
from lamina.operators.history import END, PROFILE_KEYS, START
from lamina.operators.timeline import SLICE_SECONDS, attach_effective

# Published column lists and what each measure counts.
CLIENT_ATTRIBUTES = (
    "profile_change_type", "lifecycle_stage", "account_type", "aum_tier", "retirement_horizon",
    "advice_relationship", "email_consent", "personalization_consent", "adobe_segment",
)
CAMPAIGN_ATTRIBUTES = (
    "campaign_id", "campaign_name", "theme", "objective", "primary_channel", "start_date",
    "end_date", "target_audience", "content_topic", "content_format", "status",
)
COUNTED_EVENT_TYPES = {
    "sent_count": ("SENT",),
    "delivered_count": ("DELIVERED",),
    "opened_count": ("OPENED",),
    "clicked_count": ("CLICKED",),
    "bounced_count": ("BOUNCED",),
    "unsubscribed_count": ("UNSUBSCRIBED",),
    "web_view_count": ("PAGE_VIEW", "CONTENT_VIEW"),
    "cta_click_count": ("CTA_CLICK",),
    "webinar_registered_count": ("REGISTERED",),
    "webinar_attended_count": ("ATTENDED",),
    "webinar_completed_count": ("WATCH_COMPLETED",),
}
FACT_TYPES = {
    "activity_date": "date", "client_key": "string", "campaign_key": "string",
    "channel": "string", "event_count": "long", **dict.fromkeys(COUNTED_EVENT_TYPES, "long"),
    "engagement_seconds": "long", "synthetic_record": "boolean",
}
FACT_GROUP = ("activity_date", "client_key", "campaign_key", "channel")
FACT_MEASURES = ("event_count", *COUNTED_EVENT_TYPES, "engagement_seconds")
EVENT_COLUMNS = (
    "event_id", "event_timestamp", "client_id", "campaign_id", "channel", "event_type",
    "engagement_seconds",
)


def dim_client(history: DataFrame) -> DataFrame:
    """One row per profile version, without the client id."""
    return history.select(
        version_key(F.col("client_id"), F.col(START)).alias("client_key"),
        F.col(START).alias("valid_from_timestamp"),
        F.col(END).alias("valid_to_timestamp"),
        F.isnull(END).alias("is_current_profile"),
        *CLIENT_ATTRIBUTES,
        F.lit(True).alias("synthetic_record"),
    )


def dim_campaign(campaigns: DataFrame) -> DataFrame:
    return campaigns.select(
        campaign_key(F.col("campaign_id")).alias("campaign_key"),
        *CAMPAIGN_ATTRIBUTES,
        F.lit(True).alias("synthetic_record"),
    )


def known_campaign_events(events: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Events of a published campaign.

    No broadcast hint: how many ids there are depends on the identifier pattern in use, so Spark
    decides by size. A large key side goes by a sort-merge semi join, whose skewed partitions
    adaptive execution splits.
    """
    return events.join(campaigns.select("campaign_id"), "campaign_id", "left_semi")


def effective_events(
    events: DataFrame,
    history: DataFrame,
    heavy: DataFrame | None = None,
    slice_seconds: int = SLICE_SECONDS,
    piece_rows: int | None = None,
) -> DataFrame:
    """Events with START and END of the profile version in force when they happened."""
    return attach_effective(
        events,
        history,
        keys=PROFILE_KEYS,
        at="event_timestamp",
        start=START,
        end=END,
        heavy=heavy,
        slice_seconds=slice_seconds,
        piece_rows=piece_rows,
    )


def fact_engagement_daily(
    events: DataFrame,
    history: DataFrame,
    campaigns: DataFrame,
    heavy: DataFrame | None = None,
    unique_events: bool = True,
) -> DataFrame:
    """Daily engagement per client version, campaign and channel.

    The cheap campaign filter runs before the as-of join. Grouping uses the business keys and
    hashes them afterwards: one digest per group instead of one per event. Clean events are unique
    by event_id and match at most one version, so a plain count is the distinct count and saves a
    second shuffle of all events; pass ``unique_events=False`` for input without that guarantee.
    """
    known = known_campaign_events(events.select(*EVENT_COLUMNS), campaigns)
    placed = effective_events(known, history, heavy)
    event_count = F.count("event_id") if unique_events else F.count_distinct("event_id")
    daily = placed.groupBy(
        activity_date(F.col("event_timestamp")).alias("activity_date"),
        "client_id", START, "campaign_id", "channel",
    ).agg(
        event_count.alias("event_count"),
        *(
            F.count_if(F.col("event_type").isin(*kinds)).alias(measure)
            for measure, kinds in COUNTED_EVENT_TYPES.items()
        ),
        F.sum(F.coalesce("engagement_seconds", F.lit(0))).alias("engagement_seconds"),
    )
    return daily.withColumns(
        {
            "client_key": version_key(F.col("client_id"), F.col(START)),
            "campaign_key": campaign_key(F.col("campaign_id")),
            "synthetic_record": F.lit(True),
        }
    ).select(*FACT_TYPES)


def _added_up(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*FACT_GROUP).agg(*(F.sum(name).alias(name) for name in FACT_MEASURES))


def fact_difference(now: DataFrame, before: DataFrame) -> DataFrame:
    """Signed fact rows that lead from one state of some groups to another; equal groups cancel out.

    All measures are sums over events, so the two states need only cover the events that can have
    changed sides, each with the groups those events fall into.
    """
    minus = before.withColumns({name: -F.col(name) for name in FACT_MEASURES})
    total = _added_up(now.unionByName(minus))
    changed = reduce(or_, (F.col(name) != 0 for name in FACT_MEASURES))
    return total.where(changed).withColumn("synthetic_record", F.lit(True)).select(*FACT_TYPES)


def merged_fact(first: DataFrame, late: DataFrame) -> DataFrame:
    """A fact and the signed differences that came after it; groups left without events vanish.

    Only groups that have differences are added up. While those are few they are broadcast, and the
    rest of the fact is scanned without a shuffle.
    """
    groups = late.select(*(F.col(name).alias(f"_{name}") for name in FACT_GROUP)).distinct()
    same = reduce(and_, (F.col(name).eqNullSafe(F.col(f"_{name}")) for name in FACT_GROUP))
    changed = _added_up(first.join(groups, same, "left_semi").unionByName(late))
    changed = changed.where(F.col("event_count") > 0).withColumn("synthetic_record", F.lit(True))
    untouched = first.join(groups, same, "left_anti")
    return untouched.select(*FACT_TYPES).unionByName(changed.select(*FACT_TYPES))
