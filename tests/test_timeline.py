"""Dedup, history and as-of join against brute force, with and without heavy keys."""

import random

import pytest
from conftest import at, moment, plain, raw_frame
from pyspark.sql import functions as F

from lamina.feeds import CLIENT_PROFILES
from lamina.functions.skew import heavy_keys, heavy_or_none
from lamina.operators.dedup import distinct_keys, first_arrivals
from lamina.operators.history import END, START, overlapping_versions, profile_history, type2_history
from lamina.operators.quality import candidates
from lamina.operators.timeline import attach_effective, with_next


def test_first_arrival_wins_and_nulls_are_one_identity(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), ("a", 1, "z"), (None, 5, "p"), (None, 4, "q"), ("b", 9, "r")]
    df = spark.createDataFrame(rows, "k string, _source_modified int, _source_file string")
    kept = first_arrivals(df, ["k"])
    assert plain(kept.collect()) == plain([("a", 1, "y"), (None, 4, "q"), ("b", 9, "r")])
    assert distinct_keys(df, ["k"]).count() == 3


def test_identical_copies_leave_one_row(spark):
    df = spark.range(1000).select(
        F.lit("hot").alias("k"), F.lit(1).alias("_source_modified"), F.lit("f").alias("_source_file")
    )
    assert first_arrivals(df, ["k"]).count() == 1


def test_heavy_keys_need_a_share_and_a_count(spark):
    df = spark.createDataFrame([("a",)] * 60 + [("b",)] * 30 + [(str(i),) for i in range(10)], "k string")
    assert [r.k for r in heavy_keys(df, ["k"], min_rows=5, max_keys=2).collect()] == ["a"]
    both = heavy_keys(df, ["k"], min_rows=25, max_keys=100).collect()
    assert {r.k: r.pieces for r in both} == {"a": 3, "b": 2}
    assert heavy_or_none(df, ["k"], min_rows=100) is None


FIXTURE = [
    ("CL-000001", "INSERT", at("2024-01-01"), "Prospect"),
    ("CL-000001", "UPDATE", at("2024-02-01"), "Active"),
    ("CL-000001", "DELETE", at("2024-03-01"), None),
    ("CL-000001", "INSERT", at("2024-04-01"), "Active"),
]
CHANGES = "client string, op string, seq timestamp, stage string"


def versions_of(changes, **options):
    return type2_history(
        changes, keys=["client"], sequence="seq", delete_when="op = 'DELETE'", leave_out=["op"],
        **options,
    )


@pytest.mark.parametrize("heavy", [False, True])
def test_history_of_the_written_fixture(spark, heavy):
    rows = FIXTURE[:]
    random.Random(7).shuffle(rows)
    changes = spark.createDataFrame(rows, CHANGES)
    keys = changes.select("client").distinct() if heavy else None
    history = versions_of(changes, heavy=keys)
    assert plain(history.select("stage", START, END).collect()) == plain(
        spark.createDataFrame(
            [("Prospect", at("2024-01-01"), at("2024-02-01")),
             ("Active", at("2024-02-01"), at("2024-03-01")),
             ("Active", at("2024-04-01"), None)],
            "stage string, s timestamp, e timestamp",
        ).collect()
    )
    events = spark.createDataFrame(
        [(i, "CL-000001", at(day)) for i, day in enumerate(
            ["2024-02-01", "2024-03-15", "2023-12-31", "2024-05-01", "2024-03-01"])],
        "id int, client string, happened timestamp",
    )
    placed = attach_effective(
        events, history, keys=["client"], at="happened", start=START, end=END, heavy=keys
    )
    starts = {r["id"]: r[START].strftime("%m-%d") for r in placed.collect()}
    assert starts == {0: "02-01", 3: "04-01"}
    assert overlapping_versions(history, ["client"], keys).count() == 0


def random_changes(rng, n, keys, span):
    return [
        (f"c{rng.choice([0, 0, 0, rng.randrange(keys)])}", rng.choice(["INSERT", "UPDATE", "DELETE"]),
         moment(rng.randrange(span)), str(i))
        for i, _ in enumerate(range(n))
    ]


def expected_versions(rows):
    """Straight from the definition, key by key, on the driver."""
    found = []
    for key in {row[0] for row in rows}:
        mine = sorted(
            (r for r in rows if r[0] == key), key=lambda r: (r[2], r[1] == "DELETE", r[3])
        )
        for one, after in zip(mine, mine[1:] + [None]):
            end = after[2] if after else None
            if one[1] != "DELETE" and end != one[2]:
                found.append((key, one[3], one[2], end))
    return found


@pytest.mark.parametrize("seed, slice_seconds", [(0, 1), (1, 9), (2, 1000)])
def test_history_and_asof_match_brute_force_for_any_heavy_list(spark, seed, slice_seconds):
    rng = random.Random(seed)
    rows = random_changes(rng, 300, 6, 120)
    changes = spark.createDataFrame(rows, CHANGES)
    expected = expected_versions(rows)
    schema = "client string, stage string, s timestamp, e timestamp"
    truth = plain(spark.createDataFrame(expected, schema).collect())
    events = [
        (i, f"c{rng.choice([0, 0, rng.randrange(8)])}", moment(rng.choice([40, rng.randrange(140)])))
        for i in range(400)
    ]
    event_frame = spark.createDataFrame(events, "id int, client string, happened timestamp")
    hits = sorted(
        (i, version[1])
        for i, client, happened in events
        for version in expected
        if version[0] == client and version[2] <= happened
        and (version[3] is None or happened < version[3])
    )
    for listed in (None, ["c0", "c3", "absent"]):
        heavy = spark.createDataFrame([(c,) for c in listed], "client string") if listed else None
        history = versions_of(
            changes, tie_breakers=["stage"], heavy=heavy, slice_seconds=slice_seconds
        )
        got = history.select("client", "stage", START, END)
        assert plain(got.collect()) == truth
        placed = attach_effective(
            event_frame, history, keys=["client"], at="happened", start=START, end=END,
            heavy=heavy, slice_seconds=slice_seconds, piece_rows=5,
        ).join(history.select("client", START, "stage"), ["client", START])
        assert sorted((r["id"], r["stage"]) for r in placed.collect()) == hits


def test_overlaps_are_found(spark):
    rows = [("a", moment(0), moment(10)), ("a", moment(5), None), ("b", moment(0), moment(3)),
            ("b", moment(3), None), ("c", moment(1), None), ("c", moment(1), moment(2))]
    history = spark.createDataFrame(rows, f"client string, {START} timestamp, {END} timestamp")
    assert [r.client for r in overlapping_versions(history, ["client"]).orderBy("client").collect()] == ["a", "c"]


def test_next_time_is_the_same_with_and_without_slices(spark):
    df = spark.createDataFrame(
        [("a", moment(n * n)) for n in range(30)] + [("b", moment(n)) for n in range(5)],
        "k string, t timestamp",
    )
    heavy = spark.createDataFrame([("a",)], "k string")
    even = plain(with_next(df, ["k"], "t", "n").collect())
    for seconds in (1, 10, 10_000):
        assert plain(with_next(df, ["k"], "t", "n", heavy, seconds).collect()) == even


def test_ties_do_not_depend_on_how_rows_came_in(spark):
    """Equal times, other lineage: every build keeps the same version."""
    kept = []
    for source, stamp in (("a", "2024-06-01T00:00:00"), ("z", "2025-06-01T00:00:00")):
        rows = [
            {"operation": op, "lifecycle_stage": stage, "_source_file": f"{source}{n}", "_ingest_timestamp": at(stamp),
             "client_id": f"CL-{client:06d}"}
            for client in range(40)
            for n, (op, stage) in enumerate((("INSERT", "Prospect"), ("UPDATE", "Active"), ("INSERT", "At Risk")))
        ]
        changes = candidates(raw_frame(spark, CLIENT_PROFILES, rows[:: 1 if source == "a" else -1]), CLIENT_PROFILES)
        kept.append(plain(profile_history(changes).select("client_id", "lifecycle_stage", START, END).collect()))
    assert kept[0] == kept[1] and len(kept[0]) == 40


def test_a_change_without_time_has_no_version_in_either_plan(spark):
    rows = [("a", None, "x"), ("a", moment(1), "y"), ("b", None, "z")]
    df = spark.createDataFrame(rows, "k string, t timestamp, v string")
    heavy = spark.createDataFrame([("a", 2), ("b", 2)], "k string, pieces int")
    built = [
        plain(type2_history(df, keys=["k"], sequence="t", delete_when="false", heavy=h).select("k", "v").collect())
        for h in (None, heavy)
    ]
    assert built[0] == built[1] == [("a", "y")]
