"""The published star: every publication adds what changed and becomes visible by one pointer, moved last.

A publication writes the client versions that are new or ended, the campaigns if any changed, and signed
differences of the fact. Readers follow the last row of the table of publications, so they see three tables
of one state however long the writing takes or wherever it fails; a failed run is repaired by the next.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.feeds import CAMPAIGNS, CLIENT_PROFILES, ENGAGEMENT_EVENTS, FEEDS
from lamina.functions.skew import MIN_ROWS, heavy_or_none
from lamina.functions.typing import activity_date
from lamina.operators.history import END, PROFILE_KEYS, PROFILE_SEQUENCE, START
from lamina.operators.star import EVENT_COLUMNS, dim_campaign, dim_client, fact_difference, fact_engagement_daily
from lamina.sources.lake import DAY, EVENT_DAY_COLUMNS, FACT, PUBLICATIONS, Lake, Publication
from lamina.sources.log_table import NO_BASE
from lamina.sources.tables import PUBLISHED, batches, last_batch, remove
from lamina.sources.tallies import TERM, part_of, row_term


def publish(spark: SparkSession, lake: Lake, heavy_min_rows: int = MIN_ROWS) -> Publication:
    """Bring dimensions and fact up to date, then move the pointer, then remove what nobody reads any more."""
    before = lake.last_publication(spark)
    now = _next(spark, lake, before)
    # The three tables are independent; small jobs of one fill the gaps of another.
    with ThreadPoolExecutor() as pool:
        steps = (_publish_fact, _publish_clients, _publish_campaigns)
        changes = [pool.submit(step, spark, lake, before, now, heavy_min_rows) for step in steps]
        now = reduce(lambda state, done: Publication(**vars(state) | done.result()), changes, now)
    _move_pointer(spark, lake, now)
    if before:
        _expire(spark, lake, before)
    return now


def _next(spark: SparkSession, lake: Lake, before: Publication | None) -> Publication:
    """Everything taken in so far, on the bases of the last publication."""
    return Publication(
        publication=before.publication + 1 if before else 0,
        **{feed.name: last_batch(spark, lake.arrivals_path(feed)) for feed in FEEDS},
        history=lake.history_log.last(spark),
        history_base=before.history_base if before else NO_BASE,
        dim_client_base=before.dim_client_base if before else NO_BASE,
        fact_base=before.fact_base if before else NO_BASE,
        dim_campaign_at=before.dim_campaign_at if before else 0,
    )


def _publish_clients(spark: SparkSession, lake: Lake, before: Publication | None, now: Publication, _min_rows: int) -> dict:
    """Versions of clients that changed; those they had before give way.

    Long logs are compacted here, the history's as well: it is the other table kept by client.
    """
    history, log = lake.history_log, lake.dim_client_log(spark)
    new = history.live(spark, now.history, now.history_base)
    if before is None:
        log.append(dim_client(new.drop("batch")), None, now.publication)
        _tally_clients(spark, lake, now.publication)
        return {}
    if now.history > before.history:
        touched = history.rebuilt(spark, before.history, now.history).select(*PROFILE_KEYS).distinct()
        old = history.live(spark, before.history, before.history_base)
        old, new = (df.join(touched, list(PROFILE_KEYS), "left_semi").drop("batch") for df in (old, new))
        gone = dim_client(old)
        log.append(dim_client(new), gone.withColumn(TERM, row_term(gone.columns)), now.publication)
    else:
        empty = dim_client(new.drop("batch")).limit(0)
        log.append(empty, empty.withColumn(TERM, row_term(empty.columns)), now.publication)
    _tally_clients(spark, lake, now.publication)
    bases = {}
    if history.is_long(spark, now.history, now.history_base):
        history.write_base(history.live(spark, now.history, now.history_base), now.history)
        bases["history_base"] = now.history
    if log.is_long(spark, now.publication, now.dim_client_base):
        log.write_base(log.live(spark, now.publication, now.dim_client_base), now.publication)
        bases["dim_client_base"] = now.publication
    return bases


def _tally_clients(spark: SparkSession, lake: Lake, publication: int) -> None:
    """Versions written minus versions that gave way, both as this publication has stored them."""
    log, tallies = lake.dim_client_log(spark), lake.dim_client_tallies(spark)
    gone = log.rebuilt(spark, publication - 1, publication).select(part_of(tallies.part), TERM)
    tallies.record(publication, tallies.terms(log.log(spark, publication - 1, publication)), gone)


def _publish_campaigns(spark: SparkSession, lake: Lake, before: Publication | None, now: Publication, _min_rows: int) -> dict:
    if before and before.campaigns == now.campaigns:
        return {}
    rows = dim_campaign(lake.clean(spark, CAMPAIGNS, now.campaigns))
    rows.write.mode("overwrite").parquet(lake.dim_campaign_path(now.publication))
    return {"dim_campaign_at": now.publication}


def _publish_fact(spark: SparkSession, lake: Lake, before: Publication | None, now: Publication, min_rows: int) -> dict:
    """The whole fact once, later the differences that new events, changed clients and campaigns make."""
    log = lake.fact_log
    if before is None:
        log.append(_fact(spark, lake, None, min_rows, now), None, now.publication, [DAY])
        return {}
    touched = _staged(lake, "touched_groups", touched_groups(spark, lake, before, now))
    sides = _sides(spark, lake, touched, before, now)
    # The list only steers partitioning, so that of the later state serves the earlier one as well.
    heavy = _heavy_clients(*sides[0], min_rows)
    difference = fact_difference(
        *(
            fact_engagement_daily(*side, lake.clean(spark, CAMPAIGNS, at.campaigns), heavy)
            for side, at in zip(sides, (now, before))
        )
    )
    log.append(difference, None, now.publication, [DAY])
    if not log.is_long(spark, now.publication, now.fact_base):
        return {}
    log.write_base(lake.published(spark, FACT, now), now.publication, [DAY])
    return {"fact_base": now.publication}


def touched_groups(spark: SparkSession, lake: Lake, before: Publication, now: Publication) -> DataFrame:
    """(client_id, campaign_id, activity_date) whose older events may count differently than before.

    These are events at or after a new or replaced change of their client, events of campaigns that came
    or were replaced, and what stands beside a replaced event. An event before a change keeps its version,
    whatever the change does to the end of that version. Events themselves are not read: the table of
    event days holds each client, campaign and day once.
    """
    known = lake.event_days(spark).where(F.col("batch") <= before.engagement_events)
    changes = lake.arrivals_log(CLIENT_PROFILES)
    fresh = changes.log(spark, before.client_profiles, now.client_profiles).where("accepted")
    replaced = changes.rebuilt(spark, before.client_profiles, now.client_profiles)
    at = [*PROFILE_KEYS, PROFILE_SEQUENCE]
    since = fresh.select(*at).unionAll(replaced.select(*at)).groupBy(*PROFILE_KEYS).agg(
        activity_date(F.min(PROFILE_SEQUENCE)).alias("_since")
    )
    campaigns = lake.arrivals_log(CAMPAIGNS).log(spark, before.campaigns, now.campaigns)
    given_up = lake.arrivals_log(ENGAGEMENT_EVENTS).rebuilt(spark, before.engagement_events, now.engagement_events)
    touched = (
        known.join(since, list(PROFILE_KEYS)).where(F.col(DAY) >= F.col("_since")),
        known.join(campaigns.select("campaign_id"), "campaign_id", "left_semi"),
        given_up.where(F.col(DAY).isNotNull()),
    )
    return reduce(DataFrame.unionByName, [df.select(*EVENT_DAY_COLUMNS) for df in touched]).distinct()


def _staged(lake: Lake, name: str, rows: DataFrame) -> DataFrame:
    """Rows that are read several times, written out once, so that the planner knows their size as well."""
    folder = lake.staging_path(name)
    rows.write.mode("overwrite").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _fact(
    spark: SparkSession, lake: Lake, touched: DataFrame | None, heavy_min_rows: int, at: Publication | None = None
) -> DataFrame:
    """The fact of a state, of the events named by ``touched`` if given."""
    events = lake.arrivals(spark, ENGAGEMENT_EVENTS, at.engagement_events if at else None).where("accepted")
    history = _versions(spark, lake, at)
    if touched is not None:
        events = _events_of(events, touched)
        history = history.join(events.select(*PROFILE_KEYS).distinct(), list(PROFILE_KEYS), "left_semi")
    heavy = _heavy_clients(events, history, heavy_min_rows)
    return fact_engagement_daily(events, history, lake.clean(spark, CAMPAIGNS, at.campaigns if at else None), heavy)


def _versions(spark: SparkSession, lake: Lake, at: Publication | None) -> DataFrame:
    """The whole history of a state."""
    return lake.history_log.live(spark, at.history, at.history_base) if at else lake.history(spark)


def _events_of(events: DataFrame, touched: DataFrame) -> DataFrame:
    """Events that ``touched`` names: by days, or by clients and campaigns on days."""
    names = [name for name in EVENT_DAY_COLUMNS if name in touched.columns]
    # Two values; as literals they prune partitions in the scan, the semi join does the rest.
    first, last = touched.agg(F.min(DAY), F.max(DAY)).first()
    return events.where(F.col(DAY).between(F.lit(first), F.lit(last))).join(touched, names, "left_semi")


def _sides(
    spark: SparkSession, lake: Lake, touched: DataFrame, before: Publication, now: Publication
) -> list[tuple[DataFrame, DataFrame]]:
    """(events, versions) of the later and of the former state, as far as they may count differently.

    Those are all events taken in since, the older ones that ``touched`` names, and the versions of the clients
    of both. The two states differ in older events only by those given up since, so these are looked up once and
    written out, as are the clients and the later versions; otherwise the list of heavy clients and either side
    would work them out anew.
    """
    upto = before.engagement_events
    arrivals, days = lake.arrivals_log(ENGAGEMENT_EVENTS), lake.event_days(spark)
    older = _events_of(arrivals.live(spark, upto).where("accepted"), touched).select(*EVENT_COLUMNS)
    older = _staged(lake, "touched_events", older)
    given_up = arrivals.rebuilt(spark, upto, now.engagement_events).select(*arrivals.keys)
    fresh = arrivals.live(spark, now.engagement_events).where(F.col("accepted") & (F.col("batch") > upto))
    events = older.join(given_up, list(arrivals.keys), "left_anti").unionByName(fresh.select(*EVENT_COLUMNS))
    # Clients of new events: the table of event days names them, so the events themselves need not be read.
    arrived = days.where((F.col("batch") > upto) & (F.col("batch") <= now.engagement_events))
    clients = touched.select(*PROFILE_KEYS).unionAll(arrived.select(*PROFILE_KEYS)).distinct()
    clients = _staged(lake, "clients_of_events", clients)
    later, former = (
        _versions(spark, lake, at).join(clients, list(PROFILE_KEYS), "left_semi").select(*PROFILE_KEYS, START, END)
        for at in (now, before)
    )
    return [(events, _staged(lake, "versions_of_events", later)), (older, former)]


def _heavy_clients(events: DataFrame, history: DataFrame, min_rows: int) -> DataFrame | None:
    per_client = events.select(*PROFILE_KEYS).unionAll(history.select(*PROFILE_KEYS))
    return heavy_or_none(per_client, PROFILE_KEYS, min_rows=min_rows)


def _move_pointer(spark: SparkSession, lake: Lake, now: Publication) -> None:
    values = {name: F.lit(number).cast("long") for name, number in vars(now).items()}
    row = spark.range(1).select(
        *((values | {"at": F.current_timestamp()})[name].alias(name) for name in PUBLICATIONS.names)
    )
    row.coalesce(1).write.mode("append").parquet(lake.publications_path)


def _expire(spark: SparkSession, lake: Lake, before: Publication) -> None:
    """Remove what only publications before the last one read, so that their readers can still finish."""
    lake.history_log.expire(spark, before.history_base)
    lake.dim_client_log(spark).expire(spark, before.dim_client_base)
    lake.fact_log.expire(spark, before.fact_base)
    for number in batches(spark, lake.path(PUBLISHED, "dim_campaign"), "publication="):
        if number < before.dim_campaign_at:
            remove(spark, lake.dim_campaign_path(number))
