"""Splitting a raw feed into clean rows and quarantined rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.feeds import Feed
from lamina.functions.typing import typed
from lamina.operators.dedup import first_arrivals


def candidates(raw: DataFrame, feed: Feed) -> DataFrame:
    """The typed projection every later step starts from; ``raw`` may be a stream."""
    return typed(raw, feed.timestamps, feed.dates)


def clean(raw: DataFrame, feed: Feed, rules_first: bool = False) -> DataFrame:
    """Typed, de-duplicated rows that pass every rule.

    By default duplicates go first, so a bad first copy suppresses a later good copy of the same
    identity. ``rules_first`` lets the earliest *good* copy win instead.
    """
    rows = candidates(raw, feed)
    if rules_first:
        return first_arrivals(rows.where(feed.rules.accepted()), feed.identity)
    return first_arrivals(rows, feed.identity).where(feed.rules.accepted())


def raw_payload(feed: Feed) -> Column:
    """JSON of the landed columns; NULL fields are left out."""
    return F.to_json(F.struct(*feed.types))


def quarantine(raw: DataFrame, feed: Feed, payload_from_source: bool = False) -> DataFrame:
    """Every row that fails at least one rule, duplicates included, with the reasons.

    Row by row, no shuffle. The payload shows the typed values, so text that did not parse is
    absent from it; ``payload_from_source`` keeps the text as it landed.
    """
    if payload_from_source:
        rows = candidates(raw.withColumn("_payload", raw_payload(feed)), feed)
    else:
        rows = candidates(raw, feed).withColumn("_payload", raw_payload(feed))
    return rows.where(feed.rules.rejected()).select(
        *feed.quarantine_columns,
        feed.rules.failures().alias("failed_expectations"),
        F.col("_payload").alias("raw_payload"),
        "_source_file",
        "_ingest_timestamp",
    )
