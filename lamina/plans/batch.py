"""All tables as lazy batch frames over raw feeds, for one-off runs and checks."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.feeds import CAMPAIGNS, CLIENT_PROFILES, ENGAGEMENT_EVENTS, FEEDS, Feed
from lamina.functions.skew import MIN_ROWS, heavy_or_none
from lamina.operators.history import PROFILE_KEYS, PROFILE_SEQUENCE, profile_history
from lamina.operators.quality import candidates, clean, quarantine
from lamina.operators.star import dim_campaign, dim_client, fact_engagement_daily
from lamina.operators.timeline import SLICE_SECONDS, time_cuts


@dataclass(frozen=True)
class BatchTables:
    """Tables derived from the raw frames by feed name; nothing runs before an action.

    The exception is ``heavy_clients``, which counts rows per client once to choose between the
    plan for even keys and the one for heavy keys, and finds where to cut the heavy ones. It counts rows
    that pass the rules: rejected ones often share a placeholder id, which would look like a heavy client
    that no later step sees. ``feeds`` may carry other identifier patterns than the contract's.
    """

    raw: Mapping[str, DataFrame]
    heavy_min_rows: int = MIN_ROWS
    feeds: tuple[Feed, ...] = FEEDS
    piece_rows: int | None = None
    slice_seconds: int = SLICE_SECONDS

    def feed(self, feed: Feed) -> Feed:
        return next(own for own in self.feeds if own.name == feed.name)

    def clean(self, feed: Feed) -> DataFrame:
        return clean(self.raw[feed.name], self.feed(feed))

    def quarantine(self, feed: Feed) -> DataFrame:
        return quarantine(self.raw[feed.name], self.feed(feed))

    @cached_property
    def heavy_clients(self) -> DataFrame | None:
        times = []
        for feed, at in ((CLIENT_PROFILES, PROFILE_SEQUENCE), (ENGAGEMENT_EVENTS, "event_timestamp")):
            rows = candidates(self.raw[feed.name], feed).where(self.feed(feed).rules.accepted())
            times.append(rows.select(*PROFILE_KEYS, F.col(at).alias("_time")))
        line = reduce(DataFrame.unionAll, times)
        heavy = heavy_or_none(line, PROFILE_KEYS, min_rows=self.heavy_min_rows)
        if heavy is None:
            return None
        return time_cuts(line, heavy, PROFILE_KEYS, "_time", self.piece_rows, self.slice_seconds)

    @cached_property
    def history(self) -> DataFrame:
        return profile_history(self.clean(CLIENT_PROFILES), self.heavy_clients)

    @cached_property
    def dim_client(self) -> DataFrame:
        return dim_client(self.history)

    @cached_property
    def dim_campaign(self) -> DataFrame:
        return dim_campaign(self.clean(CAMPAIGNS))

    @cached_property
    def fact_engagement_daily(self) -> DataFrame:
        return fact_engagement_daily(
            self.clean(ENGAGEMENT_EVENTS), self.history, self.clean(CAMPAIGNS), self.heavy_clients
        )

    def raw_tables(self) -> dict[str, DataFrame]:
        return {feed.raw_table: self.raw[feed.name] for feed in FEEDS}

    def quarantine_tables(self) -> dict[str, DataFrame]:
        return {feed.quarantine_table: self.quarantine(feed) for feed in FEEDS}

    def published_tables(self) -> dict[str, DataFrame]:
        return {
            "dim_client": self.dim_client,
            "dim_campaign": self.dim_campaign,
            "fact_engagement_daily": self.fact_engagement_daily,
        }
