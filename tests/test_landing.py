"""Drift rescue and incremental file ingest."""

import json
import os

import pytest
from conftest import EVENT, plain
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.feeds import ENGAGEMENT_EVENTS
from lamina.sources.drift import conform, frames_by_schema, read_with_rescue
from lamina.session import shared_folder
from lamina.sources.lake import Lake
from lamina.streaming.ingest import start_ingest

DECLARED = T.StructType().add("id", "long").add("name", "string").add("flag", "boolean")


def write(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return str(folder)


def test_every_kind_of_drift_is_rescued(spark, tmp_path):
    folders = [
        write(spark, tmp_path / "a", [(1, "x", True)], "id long, name string, flag boolean"),
        write(spark, tmp_path / "b", [(2, "y", "new", 5)], "id long, name string, extra string, n int"),
        write(spark, tmp_path / "c", [("7", "z"), ("x1", "w")], "id string, name string"),
        write(spark, tmp_path / "d", [(3, "v")], "ID int, NAME string"),
        write(spark, tmp_path / "e", [(4, ([1, 2],))], "id long, nested struct<l: array<int>>"),
    ]
    rows = read_with_rescue(spark, folders, DECLARED, {"src": F.col("_metadata.file_path")})
    found = {
        (r["id"], r["name"], r["flag"]): r["_rescued_data"] and json.loads(r["_rescued_data"])
        for r in rows.collect()
    }
    assert found == {
        (1, "x", True): None,
        (2, "y", None): {"extra": "new", "n": 5},
        (7, "z", None): None,
        (None, "w", None): {"id": "x1"},
        (3, "v", None): None,
        (4, None, None): {"nested": {"l": [1, 2]}},
    }
    assert rows.columns == ["id", "name", "flag", "_rescued_data", "src"]


def test_files_without_conflict_are_read_as_one_frame(spark, tmp_path):
    folders = [
        write(spark, tmp_path / "a", [(1, "x")], "id long, name string"),
        write(spark, tmp_path / "b", [(2, "y", "z")], "id long, name string, extra string"),
    ]
    assert len(frames_by_schema(spark, folders)) == 1
    odd = write(spark, tmp_path / "c", [("q",)], "id string")
    mixed = frames_by_schema(spark, [folders[0], odd, folders[1], odd])
    assert sum(frame.count() for frame in mixed) == 4


def test_nothing_to_rescue_is_null(spark):
    df = spark.createDataFrame([(1, "a", True, None)], "id long, name string, flag boolean, more string")
    assert conform(df, DECLARED).first()["_rescued_data"] is None


def land(spark, folder, ids, **changes):
    rows = [{**EVENT, "event_id": f"EVT-{i:08d}", **changes} for i in ids]
    schema = ENGAGEMENT_EVENTS.landed_schema
    extra = [name for name in changes if name not in schema.names]
    for name in extra:
        schema.add(name, "string")
    write(spark, folder, [tuple(row[n] for n in schema.names) for row in rows], schema)


def test_each_file_is_ingested_once_and_repeated_batches_leave_no_copies(spark, tmp_path):
    landing, lake = tmp_path / "landing", Lake(str(tmp_path / "lake"))

    def ingest():
        start_ingest(spark, ENGAGEMENT_EVENTS, str(landing), lake, max_files=2).awaitTermination()
        return lake.raw(spark, ENGAGEMENT_EVENTS)

    for start in (0, 10, 20):
        land(spark, landing, range(start, start + 5))
    assert ingest().count() == 15
    assert ingest().count() == 15
    land(spark, landing / "later", range(30, 33), surprise="drift")
    raw = ingest()
    assert raw.count() == 18
    assert plain(raw.groupBy("_rescued_data").count().collect()) == plain(
        [('{"surprise":"drift"}', 3), (None, 15)]
    )
    assert raw.where("_ingest_timestamp IS NULL OR _source_file NOT LIKE '%.parquet'").count() == 0
    assert {r[0] for r in raw.select("_source_system").distinct().collect()} == {
        ENGAGEMENT_EVENTS.source_label
    }
    # Lose the last commit mark, as when the job dies after writing: its batch runs again.
    commits = tmp_path / "lake" / "_checkpoints" / "engagement_events_raw" / "commits"
    last = max(int(mark.name) for mark in commits.iterdir() if mark.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        (commits / name).unlink(missing_ok=True)
    assert ingest().count() == 18


def test_neither_age_nor_name_keeps_a_file_out(spark, tmp_path):
    landing, lake = tmp_path / "landing", Lake(str(tmp_path / "lake"))

    def ingest():
        start_ingest(spark, ENGAGEMENT_EVENTS, str(landing), lake).awaitTermination()
        return sorted(row.event_id for row in lake.raw(spark, ENGAGEMENT_EVENTS).collect())

    land(spark, landing, [1])
    assert len(ingest()) == 1
    land(spark, landing / "old", [2])
    land(spark, landing / "new", [3])
    for file in (landing / "old").glob("*.parquet"):
        renamed = file.with_name("delivery.data")
        file.rename(renamed)
        os.utime(renamed, (1_500_000_000, 1_500_000_000))
    assert ingest() == ["EVT-00000001", "EVT-00000002", "EVT-00000003"]


def test_a_fraction_that_does_not_fit_is_rescued(spark):
    df = spark.createDataFrame([(12.7, "a", True), (12.0, "b", False)], "id double, name string, flag boolean")
    rows = {row["name"]: row for row in conform(df, DECLARED).collect()}
    assert rows["a"]["id"] == 12 and rows["a"]["_rescued_data"] == '{"id":12.7}'
    assert rows["b"]["id"] == 12 and rows["b"]["_rescued_data"] is None


def test_shared_folder_needs_a_setting_off_local_masters():
    class Elsewhere:
        conf = {}

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(Elsewhere(), "x")
