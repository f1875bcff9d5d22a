"""Raw table to clean and quarantined rows, new rows only."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lamina.feeds import CLIENT_PROFILES, ENGAGEMENT_EVENTS, Feed
from lamina.functions.typing import activity_date
from lamina.operators.dedup import arrival_order, first_arrivals
from lamina.operators.quality import candidates, quarantine
from lamina.sources.lake import DAY, EVENT_DAY_COLUMNS, Lake
from lamina.sources.landing import NO_MAX_AGE
from lamina.sources.members import earlier_copies
from lamina.sources.tables import batches
from lamina.sources.tallies import PART, TERM, part_of, row_term


def profile_bucket(buckets: int):
    return F.pmod(F.xxhash64("client_id"), F.lit(buckets)).cast("int")


def unseen_or_older(
    rows: DataFrame, seen: DataFrame, identity: tuple[str, ...], told: Sequence[Column] = ()
) -> DataFrame:
    """Rows whose identity is not in ``seen``, or is there by a copy that came later than theirs.

    Adds ``_former``: NULL for new identities, else the place columns of the copy that gives way and what
    ``told`` says of it. NULL identities are equal. ``seen`` is first cut down to the identities of ``rows``. When those are few,
    Spark broadcasts them and the long ``seen`` side is only scanned, not shuffled. Both sides hold an
    identity once, so no join has a heavy key.
    """
    former = F.struct(*(c for c in EVENT_DAY_COLUMNS if c in seen.columns), *told, F.lit(True).alias("_there"))
    stored = seen.select(
        *(F.col(name).alias(f"_other_{name}") for name in identity),
        arrival_order(rows.columns).alias("_taken"), former.alias("_former"),
    )
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_other_{c}")) for c in identity))
    repeated = stored.join(rows.select(*identity), same, "left_semi")
    met = rows.join(repeated, same, "left").withColumn("_order", arrival_order(rows.columns))
    kept = met.where(F.col("_taken").isNull() | (F.col("_order") < F.col("_taken")))
    return kept.select(*rows.columns, "_former")


def start_clean(spark: SparkSession, feed: Feed, lake: Lake) -> StreamingQuery:
    """Append first copies and quarantined rows of the raw rows that are new since the last run.

    Duplicates inside a micro-batch go by an aggregate that combines before its shuffle; those of
    earlier batches by joins with the identities already stored, of which fingerprints tell the partitions
    to read. A stateful
    ``dropDuplicates`` would send every copy of a hot identity through one task and keep its
    state on executors. A copy from an older file than the one taken before takes its place, so the
    order in which files land does not matter; the replaced identities are listed beside the rows.
    """
    log, members, tallies = lake.arrivals_log(feed), lake.arrivals_members(feed), lake.clean_tallies(feed)

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        raw = batch.select(feed.raw_schema.names)
        rows = first_arrivals(candidates(raw, feed), feed.identity)
        replaced = given_up = None
        if batch_id > 0:
            # Written out so that the planner knows the size of the new rows.
            rows.write.mode("overwrite").parquet(lake.staging_path(feed.name))
            rows = session.read.schema(feed.typed_schema).parquet(lake.staging_path(feed.name))
            known = [number for number in batches(session, log.rows_path) if number < batch_id]
            seen = earlier_copies(rows, members, log.live(session, batch_id - 1), known)
            told = (F.col("accepted"), part_of(tallies.part), row_term(tallies.columns))
            rows = unseen_or_older(rows, seen, feed.identity, told)
            rows.write.mode("overwrite").parquet(lake.staging_path(f"{feed.name}_taken"))
            rows = session.read.schema(rows.schema).parquet(lake.staging_path(f"{feed.name}_taken"))
            replaced = rows.where("_former IS NOT NULL")
            given_up = replaced.where("_former.accepted").select(f"_former.{PART}", f"_former.{TERM}")
            beside = [F.col(f"_former.{name}").alias(name) for name, _ in log.key_columns]
            replaced = replaced.select(*feed.identity, *beside)
            rows = rows.drop("_former")
        rows = rows.withColumn("accepted", feed.rules.accepted())
        parts = ["accepted"]
        if feed.name == CLIENT_PROFILES.name:
            parts.append("bucket")
            rows = rows.withColumn("bucket", profile_bucket(lake.buckets))
        if feed.name == ENGAGEMENT_EVENTS.name:
            # Differences of the fact are worked out from the events of some days, so those stand together.
            parts.append(DAY)
            rows = rows.withColumn(DAY, activity_date(F.col("event_timestamp")))
        log.append(rows, replaced, batch_id, parts)
        written = session.read.schema(lake.arrivals_schema(feed)).parquet(
            f"{lake.arrivals_path(feed)}/batch={batch_id}"
        )
        steps = [
            lambda: members.record(written, batch_id),
            lambda: tallies.record(batch_id, tallies.terms(written.where("accepted")), given_up),
            lambda: write_rejected(raw, batch_id),
        ]
        if feed.name == ENGAGEMENT_EVENTS.name:
            days = written.where("accepted").select(*EVENT_DAY_COLUMNS).distinct()
            steps.append(lambda: days.write.mode("overwrite").parquet(f"{lake.event_days_path}/batch={batch_id}"))
        # Independent of each other; every one overwrites its own folder, so a repeated batch repairs a failed one.
        with ThreadPoolExecutor(len(steps)) as pool:
            for done in [pool.submit(step) for step in steps]:
                done.result()

    def write_rejected(raw: DataFrame, batch_id: int) -> None:
        session = raw.sparkSession
        rejected, folder = quarantine(raw, feed), f"{lake.quarantine_path(feed)}/batch={batch_id}"
        rejected.hint("rebalance").write.mode("overwrite").parquet(folder)
        bad = lake.quarantine_tallies(feed)
        bad.record(batch_id, bad.terms(session.read.schema(rejected.schema).parquet(folder)))

    return (
        spark.readStream.option("maxFileAge", NO_MAX_AGE).schema(feed.raw_schema)
        .parquet(lake.raw_path(feed))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", lake.checkpoint(feed.clean_table))
        .trigger(availableNow=True)
        .start()
    )
