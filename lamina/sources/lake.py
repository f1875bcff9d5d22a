"""Folder layout of one generation of tables, and reading them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.feeds import CLIENT_PROFILES, ENGAGEMENT_EVENTS, FEEDS, Feed, struct
from lamina.operators.history import END, PROFILE_KEYS, PROFILE_LEFT_OUT, START
from lamina.operators.quality import quarantine
from lamina.operators.star import FACT_GROUP, FACT_TYPES, dim_client, merged_fact
from lamina.sources.log_table import NO_BASE, LogTable
from lamina.sources.members import Members
from lamina.sources.tables import CLEAN, PUBLISHED, RAW, read_or_empty
from lamina.sources.tallies import TERM, Tallies

PROFILE_BUCKETS = 256
FACT = "fact_engagement_daily"
DAY = "activity_date"
# What decides whether a change of a client or a campaign touches an event.
EVENT_DAY_COLUMNS = ("client_id", "campaign_id", DAY)
EVENT_DAY_TYPES = {"client_id": "string", "campaign_id": "string", DAY: "date"}


# One row per publication: how much of each table it shows, and the bases to read. The last row is the
# pointer that all readers follow; it is written after everything it names.
PUBLICATIONS = struct(
    {
        "publication": "long", **{feed.name: "long" for feed in FEEDS}, "history": "long", "history_base": "long",
        "dim_client_base": "long", "fact_base": "long", "dim_campaign_at": "long", "at": "timestamp",
    }
)


@dataclass(frozen=True)
class Publication:
    """One row of the table of publications: a state of the star that is complete and stays as it is."""

    publication: int
    client_profiles: int
    campaigns: int
    engagement_events: int
    history: int
    history_base: int
    dim_client_base: int
    fact_base: int
    dim_campaign_at: int

    def upto(self, feed: Feed) -> int:
        return getattr(self, feed.name)


@dataclass(frozen=True)
class Lake:
    """One generation. A full refresh starts a new one, an incremental refresh extends it."""

    root: str
    buckets: int = PROFILE_BUCKETS

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def checkpoint(self, job: str) -> str:
        return f"{self.root}/_checkpoints/{job}"

    def staging_path(self, name: str) -> str:
        """Short-lived output of one step, overwritten by its next run."""
        return f"{self.root}/_staging/{name}"

    def raw_path(self, feed: Feed) -> str:
        return self.path(RAW, feed.raw_table)

    def arrivals_path(self, feed: Feed) -> str:
        """First copies of every identity, whether accepted or not.

        The accepted ones are the clean table; all of them are what later copies are checked
        against, so the de-duplication state is an ordinary table in shared storage.
        """
        return self.path(CLEAN, f"{feed.name}_arrivals")

    def quarantine_path(self, feed: Feed) -> str:
        return self.path(CLEAN, feed.quarantine_table)

    @property
    def event_days_path(self) -> str:
        """Which clients and campaigns have accepted events on which days, per batch."""
        return self.path(CLEAN, "event_days")

    def event_days(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, self.event_days_path, struct({**EVENT_DAY_TYPES, "batch": "long"}))

    def arrivals_schema(self, feed: Feed) -> T.StructType:
        schema = feed.typed_schema.add("batch", "long").add("accepted", "boolean")
        if feed.name == ENGAGEMENT_EVENTS.name:
            schema = schema.add(DAY, "date")
        return schema.add("bucket", "integer") if feed.name == CLIENT_PROFILES.name else schema

    def arrivals_log(self, feed: Feed) -> LogTable:
        """First copies; a batch that brings an older copy than the one taken rebuilds that identity.

        For events the log keeps beside a replaced identity where its former copy stood.
        """
        schema = T.StructType([f for f in self.arrivals_schema(feed) if f.name != "batch"])
        beside = tuple(EVENT_DAY_TYPES.items()) if feed.name == ENGAGEMENT_EVENTS.name else ()
        return LogTable(f"{self.root}/{CLEAN}", schema, feed.identity, beside, f"{feed.name}_arrivals")

    def arrivals_members(self, feed: Feed) -> Members:
        """Which batch, and which bucket or day of it, took in an identity."""
        schema = self.arrivals_schema(feed)
        place = {CLIENT_PROFILES.name: "bucket", ENGAGEMENT_EVENTS.name: DAY}.get(feed.name)
        return Members(self.path(CLEAN, f"{feed.name}_members"), feed.identity, schema[place] if place else None)

    @property
    def history_log(self) -> LogTable:
        """Versions, rebuilt client by client."""
        types = candidates_schema().add(START, "timestamp").add(END, "timestamp")
        return LogTable(self.path(CLEAN, "client_profile_history"), types, PROFILE_KEYS)

    def dim_client_log(self, spark: SparkSession) -> LogTable:
        """Published versions; a batch is a publication and rebuilds the keys that ended or changed.

        Beside a key stands the hash of the version that gave way, for the tally.
        """
        types = dim_client(spark.createDataFrame([], self.history_log.schema)).schema
        return LogTable(self.path(PUBLISHED, "dim_client"), types, ("client_key",), ((TERM, "long"),))

    def raw_tallies(self, feed: Feed) -> Tallies:
        return Tallies(self.path(RAW, f"{feed.name}_tallies"), tuple(feed.raw_schema.names))

    def clean_tallies(self, feed: Feed) -> Tallies:
        """Accepted rows that count, by bucket or day."""
        place = self.arrivals_members(feed).place
        names = tuple(feed.typed_schema.names)
        return Tallies(self.path(CLEAN, f"{feed.name}_tallies"), names, place.name if place else None)

    def quarantine_tallies(self, feed: Feed) -> Tallies:
        names = (*feed.quarantine_columns, "failed_expectations", "raw_payload")
        return Tallies(self.path(CLEAN, f"{feed.quarantine_table}_tallies"), names)

    def dim_client_tallies(self, spark: SparkSession) -> Tallies:
        names = tuple(self.dim_client_log(spark).schema.names)
        return Tallies(self.path(PUBLISHED, "dim_client_tallies"), names)

    @property
    def fact_log(self) -> LogTable:
        """Measures to be added up per group; a batch is a publication and holds signed differences."""
        return LogTable(self.path(PUBLISHED, FACT), struct(FACT_TYPES), FACT_GROUP)

    def dim_campaign_path(self, publication: int) -> str:
        return f"{self.path(PUBLISHED, 'dim_campaign')}/publication={publication}"

    @property
    def publications_path(self) -> str:
        return f"{self.root}/_publications"

    def last_publication(self, spark: SparkSession) -> Publication | None:
        """What readers of the star see now, or None before the first publication."""
        rows = read_or_empty(spark, self.publications_path, PUBLICATIONS)
        last = rows.orderBy(F.desc("publication")).drop("at").first()
        return Publication(**last.asDict()) if last else None

    def raw(self, spark: SparkSession, feed: Feed) -> DataFrame:
        rows = read_or_empty(spark, self.raw_path(feed), feed.raw_schema)
        return rows.select(feed.raw_schema.names)

    def arrivals(self, spark: SparkSession, feed: Feed, upto: int | None = None) -> DataFrame:
        return self.arrivals_log(feed).live(spark, upto)

    def clean(self, spark: SparkSession, feed: Feed, upto: int | None = None) -> DataFrame:
        accepted = self.arrivals(spark, feed, upto).where("accepted")
        return accepted.select(feed.typed_schema.names)

    def quarantined(self, spark: SparkSession, feed: Feed) -> DataFrame:
        like = quarantine(spark.createDataFrame([], feed.raw_schema), feed)
        return read_or_empty(spark, self.quarantine_path(feed), like.schema).select(like.columns)

    def history(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """All versions; the newest rebuild of a client counts."""
        shown = self.last_publication(spark)
        base = shown.history_base if shown and (upto is None or upto >= shown.history_base) else NO_BASE
        return self.history_log.live(spark, upto, base).drop("batch")

    def published(self, spark: SparkSession, name: str, at: Publication | None = None) -> DataFrame:
        """A table of the star as of one publication, the last by default."""
        at = at or self.last_publication(spark)
        if at is None:
            raise FileNotFoundError(f"nothing has been published in {self.root}")
        if name == "dim_client":
            return self.dim_client_log(spark).live(spark, at.publication, at.dim_client_base).drop("batch")
        if name == FACT:
            log, base = self.fact_log, at.fact_base
            if base == NO_BASE:
                base = 0
                first = log.log(spark, NO_BASE, 0).drop("batch")
            else:
                first = spark.read.schema(log.schema).parquet(log.base_path(base))
            if base == at.publication:
                return first.select(*FACT_TYPES)
            return merged_fact(first, log.log(spark, base, at.publication).drop("batch"))
        return spark.read.parquet(self.dim_campaign_path(at.dim_campaign_at))

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        """Every table by name."""
        found = {feed.raw_table: self.raw(spark, feed) for feed in FEEDS}
        found |= {feed.clean_table: self.clean(spark, feed) for feed in FEEDS}
        found |= {feed.quarantine_table: self.quarantined(spark, feed) for feed in FEEDS}
        found["client_profile_history"] = self.history(spark)
        for name in ("dim_client", "dim_campaign", FACT):
            found[name] = self.published(spark, name)
        return found


def candidates_schema() -> T.StructType:
    """Columns a profile version takes over from its change."""
    return T.StructType([f for f in CLIENT_PROFILES.typed_schema if f.name not in PROFILE_LEFT_OUT])
