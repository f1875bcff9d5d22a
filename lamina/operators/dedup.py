"""One row per identity: the copy that arrived first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A file's age and name do not depend on how files were cut into batches, an ingest time does.
ARRIVAL = ("_source_modified", "_source_file")
# Columns that say how a row came in; they decide no tie.
SYSTEM = ("_ingest_timestamp", "_source_file", "_source_modified", "_source_system", "bucket", "batch")


def arrival_order(columns: Sequence[str], arrival: Sequence[str] = ARRIVAL) -> Column:
    """Which of two copies came first: age and name of the file, then a hash of the landed columns."""
    order = [F.col(name) for name in arrival if name in columns]
    return F.struct(*order, F.xxhash64(*(c for c in columns if c not in SYSTEM)).alias("_tie"))


def first_arrivals(
    df: DataFrame, identity: Sequence[str], arrival: Sequence[str] = ARRIVAL
) -> DataFrame:
    """Keep the earliest copy of every identity; equal arrivals are settled by a hash of the landed columns.

    Spark applies the limit of one per group before the shuffle as well as after it (the
    WindowGroupLimit steps of the plan), so an identity holding a third of all rows sends one row
    per task instead of filling one task. Columns stay flat and unused ones are pruned. NULL
    identities count as equal to each other.
    """
    order = [name for name in arrival if name in df.columns]
    by_arrival = Window.partitionBy(*identity).orderBy(*order, "_tie")
    return (
        df.withColumn("_tie", arrival_order(df.columns, arrival)["_tie"])
        .withColumn("_copy", F.row_number().over(by_arrival))
        .where(F.col("_copy") == 1)
        .select(*df.columns)
    )


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).dropDuplicates()
