"""Tallies against recounts, through refreshes with late older files, failures and repeated batches."""

import random

import pytest
from conftest import plain
from test_refresh import iso, land, small_feeds

from lamina.feeds import CLIENT_PROFILES, ENGAGEMENT_EVENTS, FEEDS
from lamina.operators.contract import conservation
from lamina.plans.agreement import agreement, counted, differing_parts, feed_balance, tallied_tables
from lamina.plans.refresh import FULL, Settings, refresh
from lamina.sources.landing import set_modified
from lamina.sources.tallies import Tallies

ROWS = "k string, v int, p string, _source_file string"


def test_tallies_add_up(spark, tmp_path):
    tallies = Tallies(f"{tmp_path}/t", ("k", "v", "p", "_source_file"), "p")
    of = lambda rows: tallies.terms(spark.createDataFrame(rows, ROWS))
    first = [("a", 1, "x", "f"), ("a", 1, "x", "g"), ("b", None, "y", "f"), (None, 2, None, "f")]
    second = [("c", 3, "y", "h"), ("d", 4, "z", "h")]
    gone = [first[0], first[3]]
    tallies.record(0, of(first))
    for _ in range(2):
        tallies.record(1, of(second), of(gone))
    left = spark.createDataFrame([first[1], first[2], *second], ROWS)
    assert plain(tallies.totals(spark, 1).collect()) == plain(tallies.recounted(left).collect())
    assert {r.part for r in tallies.totals(spark, 0).collect()} == {"x", "y", "null"}
    assert tallies.covers(spark, [0, 1]) and not tallies.covers(spark, [0, 1, 2])
    empty = Tallies(f"{tmp_path}/none", ("k",))
    assert empty.totals(spark, 5).collect() == [] and empty.covers(spark, [])


def test_a_value_in_another_column_changes_the_digest(spark, tmp_path):
    tallies = Tallies(f"{tmp_path}/t", ("k", "v", "p"))
    one, other = (
        tallies.recounted(spark.createDataFrame(rows, "k string, v string, p string")).first().digest
        for rows in ([("a", None, None)], [(None, "a", None)])
    )
    assert one != other


def test_observed_writes_equal_a_recount(spark, tmp_path):
    tallies = Tallies(f"{tmp_path}/t", ("id",))
    rows = spark.range(0, 5000, 1, 7)
    for _ in range(2):
        tallies.write_observed(rows, f"{tmp_path}/rows", 0)
    assert spark.read.parquet(f"{tmp_path}/rows").count() == 5000
    assert tallies.totals(spark, 0).collect() == tallies.recounted(rows).collect()
    tallies.write_observed(rows.limit(0), f"{tmp_path}/more", 1)
    assert tallies.totals(spark, 1).first().row_count == 5000


@pytest.fixture(scope="module")
def lakes(spark, tmp_path_factory):
    """A lake grown by three deliveries of which each is older than the one before, and one built at once."""
    home = tmp_path_factory.mktemp("tallies")
    settings = Settings(f"{home}/landing", f"{home}/lake", buckets=4)
    feeds = small_feeds(random.Random(4))
    for number in range(3):
        for feed, rows in feeds.items():
            land(spark, settings, feed, number, rows[number::3])
            set_modified(spark, f"{settings.folder(feed)}/delivery-{number}", (2_000_000_000 - number * 3600) * 1000)
        grown = refresh(spark, settings)
    whole = refresh(spark, settings, FULL)
    event = {**feeds[ENGAGEMENT_EVENTS][0], "event_id": "EVT-99999999", "event_timestamp": iso(7 * 86_400),
             "event_type": "SENT", "engagement_seconds": 5}
    land(spark, settings, ENGAGEMENT_EVENTS, 3, [event])
    return settings, grown, whole, refresh(spark, settings)


def test_tallies_of_a_lake_equal_recounts(spark, lakes):
    for lake in lakes[1:]:
        for name, table in tallied_tables(spark, lake).items():
            assert table.tallies.covers(spark, table.known), name
            assert plain(table.totals().collect()) == plain(table.tallies.recounted(table.rows).collect()), name
    tables = tallied_tables(spark, lakes[1])
    told = {r.asset: r.actual_rows for r in counted(tables).collect()}
    assert told == {name: table.rows.count() for name, table in tables.items()}
    # Copies did give way, or this test shows little.
    assert lakes[1].arrivals_log(ENGAGEMENT_EVENTS).rebuilt(spark).count() > 0


def test_balance_reads_raw_once(spark, lakes):
    lake = lakes[1]
    for feed in FEEDS:
        found = feed_balance(spark, lake, feed)
        recount = conservation(lake.raw(spark, feed), lake.clean(spark, feed), lake.quarantined(spark, feed), feed)
        assert found.collect() == recount.collect() and found.first().balanced
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        files = [path for path in found.inputFiles() if "_tallies/" not in path]
        assert files and all(f"/{feed.raw_table}/" in path for path in files), plan


def test_equal_lakes_agree_without_reading_rows(spark, lakes):
    _, grown, whole, _ = lakes
    grown_tables, whole_tables = (tallied_tables(spark, lake) for lake in (grown, whole))
    # The lake was extended since, so only tables of other feeds are equal by now.
    for name in (CLIENT_PROFILES.raw_table, CLIENT_PROFILES.clean_table, CLIENT_PROFILES.quarantine_table, "dim_client"):
        parts = differing_parts(grown_tables[name], whole_tables[name]).collect()
        assert parts and all(part.same for part in parts), name


def test_only_days_that_differ_are_read(spark, lakes, monkeypatch):
    from lamina.plans import agreement as module

    _, before, _, after = lakes
    read = {}
    real = module._of_parts

    def watched(side, named, differ):
        read[side.tallies.path] = list(named)
        return real(side, named, differ)

    monkeypatch.setattr(module, "_of_parts", watched)
    rows = {r.asset: r for r in agreement(spark, before, after).collect()}
    for name, row in rows.items():
        left, right = (lake.tables(spark)[name] for lake in (before, after))
        lineage = ("_ingest_timestamp", "_source_file", "_source_modified")
        left, right = ([tuple(r) for r in df.drop(*lineage).collect()] for df in (left, right))
        only_left, only_right = list(left), list(right)
        for r in right:
            if r in only_left:
                only_left.remove(r)
        for r in left:
            if r in only_right:
                only_right.remove(r)
        assert (row.left_rows, row.right_rows, row.only_left, row.only_right) == (
            len(left), len(right), len(only_left), len(only_right)), name
    days = read[after.clean_tallies(ENGAGEMENT_EVENTS).path]
    assert days == ["2024-01-08"], days
    assert after.clean_tallies(CLIENT_PROFILES).path not in read


def test_a_batch_without_tally_is_counted_from_its_rows(spark, lakes):
    from dataclasses import replace

    table = tallied_tables(spark, lakes[2])[CLIENT_PROFILES.clean_table]
    lost = replace(table, tallies=replace(table.tallies, path=f"{table.tallies.path}_lost"))
    assert plain(lost.totals().collect()) == plain(table.totals().collect())
