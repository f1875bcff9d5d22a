"""Full and incremental refresh of all tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lamina.feeds import CLIENT_PROFILES, FEEDS, Feed
from lamina.functions.skew import MIN_ROWS
from lamina.plans.naming import name_tables
from lamina.plans.publish import publish
from lamina.session import pin_session
from lamina.sources.lake import PROFILE_BUCKETS, Lake
from lamina.sources.landing import MAX_FILES_PER_BATCH
from lamina.sources.tables import Namespace, exists, read_or_empty
from lamina.streaming.clean import start_clean
from lamina.streaming.history import start_history
from lamina.streaming.ingest import start_ingest

FULL, INCREMENTAL = "full", "incremental"
GENERATIONS = (
    T.StructType().add("generation", "long").add("buckets", "integer").add("finished_at", "timestamp")
)


@dataclass(frozen=True)
class Settings:
    """Where files land and tables live; ``namespace`` also gives the tables catalog names.

    ``feeds`` may carry other identifier patterns and source labels than the contract's.
    """

    landing: str
    root: str
    folders: dict[str, str] = field(default_factory=dict)
    buckets: int = PROFILE_BUCKETS
    max_files: int = MAX_FILES_PER_BATCH
    heavy_min_rows: int = MIN_ROWS
    namespace: Namespace | None = None
    feeds: tuple[Feed, ...] = FEEDS

    @classmethod
    def from_conf(cls, spark: SparkSession, root: str) -> Settings:
        """Landing path and names as the session configuration gives them."""
        names = Namespace.from_conf(spark)
        return cls(landing=names.landing_path, root=root, namespace=names)

    def folder(self, feed: Feed) -> str:
        return f"{self.landing}/{self.folders.get(feed.name, feed.name)}"


def current_lake(spark: SparkSession, root: str) -> Lake | None:
    """The last generation that was finished, or None before the first."""
    done = read_or_empty(spark, f"{root}/_generations", GENERATIONS)
    last = done.orderBy(F.desc("generation")).first()
    return Lake(f"{root}/generation={last.generation}", last.buckets) if last else None


def refresh(spark: SparkSession, settings: Settings, mode: str = INCREMENTAL) -> Lake:
    """Bring every table up to date with the landed files.

    ``full`` rebuilds everything in a new generation, which readers see once it is complete.
    ``incremental`` takes in new files only and keeps what was learnt from the old ones; the first
    refresh of a root is always a full one.
    """
    pin_session(spark)
    lake = current_lake(spark, settings.root) if mode == INCREMENTAL else None
    fresh = lake is None
    if fresh:
        lake = new_lake(spark, settings)
    take_in(spark, lake, settings)
    publish(spark, lake, settings.heavy_min_rows)
    if fresh:
        _record_generation(spark, settings, lake)
    if settings.namespace:
        name_tables(spark, lake, settings.namespace)
    return lake


def take_in(spark: SparkSession, lake: Lake, settings: Settings) -> None:
    """New landed files to raw, clean and quarantined rows, and to history."""
    landed = [feed for feed in settings.feeds if exists(spark, settings.folder(feed))]
    _finish(
        start_ingest(spark, feed, settings.folder(feed), lake, settings.max_files)
        for feed in landed
    )
    stored = [feed for feed in settings.feeds if exists(spark, lake.raw_path(feed))]
    _finish(start_clean(spark, feed, lake) for feed in stored)
    if exists(spark, lake.arrivals_path(CLIENT_PROFILES)):
        _finish([start_history(spark, lake, settings.heavy_min_rows)])


def _finish(queries: Iterable[StreamingQuery]) -> None:
    """Start all, then wait for all, so that independent feeds share the cluster."""
    for query in list(queries):
        query.awaitTermination()


def new_lake(spark: SparkSession, settings: Settings) -> Lake:
    """An empty generation after all earlier ones, finished or not."""
    number = 0
    while exists(spark, f"{settings.root}/generation={number}"):
        number += 1
    return Lake(f"{settings.root}/generation={number}", settings.buckets)


def _record_generation(spark: SparkSession, settings: Settings, lake: Lake) -> None:
    number = int(lake.root.rsplit("=", 1)[1])
    row = spark.range(1).select(
        F.lit(number).cast("long").alias("generation"),
        F.lit(lake.buckets).cast("int").alias("buckets"),
        F.current_timestamp().alias("finished_at"),
    )
    row.write.mode("append").parquet(f"{settings.root}/_generations")
