"""Landed files to the append-only raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lamina.feeds import Feed
from lamina.sources.lake import Lake
from lamina.sources.landing import MAX_FILES_PER_BATCH, landed_paths, read_landed


def start_ingest(
    spark: SparkSession,
    feed: Feed,
    folder: str,
    lake: Lake,
    max_files: int = MAX_FILES_PER_BATCH,
) -> StreamingQuery:
    """Take in every file not seen before, then stop.

    A micro-batch owns one folder of the raw table and overwrites it, so a repeated batch leaves
    no duplicates.
    """
    target = lake.raw_path(feed)

    def write(batch: DataFrame, batch_id: int) -> None:
        # At most max_files short strings.
        paths = [row.path for row in batch.collect()]
        if paths:
            raw = read_landed(batch.sparkSession, paths, feed)
            lake.raw_tallies(feed).write_observed(raw, f"{target}/batch={batch_id}", batch_id)

    return (
        landed_paths(spark, folder, max_files)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", lake.checkpoint(feed.raw_table))
        .trigger(availableNow=True)
        .start()
    )
