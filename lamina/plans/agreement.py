"""Checks on lakes that read the tallies of their tables first, and rows only where those differ."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.feeds import FEEDS, Feed
from lamina.operators.contract import balanced, differences, raw_and_suppressed
from lamina.sources.lake import Lake
from lamina.sources.tables import batches
from lamina.sources.tallies import LINEAGE, PART, Tallies, part_of

#: Beyond so many differing parts they are joined instead of named; the result is the same.
MOST_PARTS = 10_000


@dataclass(frozen=True)
class Tallied:
    """A table with its tally. ``rows`` has the table's columns and the column of parts."""

    tallies: Tallies
    rows: DataFrame
    known: tuple[int, ...]

    @property
    def upto(self) -> int:
        return max(self.known, default=-1)

    def totals(self) -> DataFrame:
        """(part, row_count, digest), from the rows themselves while a batch lacks its tally."""
        spark = self.rows.sparkSession
        if self.tallies.covers(spark, self.known):
            return self.tallies.totals(spark, self.upto)
        return self.tallies.recounted(self.rows)


def tallied_tables(spark: SparkSession, lake: Lake) -> dict[str, Tallied]:
    """Raw, clean and quarantined tables and ``dim_client`` with their tallies."""
    found = {}
    for feed in FEEDS:
        raw = tuple(batches(spark, lake.raw_path(feed)))
        clean = tuple(batches(spark, lake.arrivals_path(feed)))
        bad = tuple(batches(spark, lake.quarantine_path(feed)))
        found[feed.raw_table] = Tallied(lake.raw_tallies(feed), lake.raw(spark, feed), raw)
        found[feed.clean_table] = Tallied(lake.clean_tallies(feed), lake.arrivals(spark, feed).where("accepted"), clean)
        found[feed.quarantine_table] = Tallied(lake.quarantine_tallies(feed), lake.quarantined(spark, feed), bad)
    at = lake.last_publication(spark)
    if at:
        # A later publication may have been begun; the pointer tells which one counts.
        shown = tuple(n for n in batches(spark, lake.dim_client_log(spark).rows_path) if n <= at.publication)
        found["dim_client"] = Tallied(lake.dim_client_tallies(spark), lake.published(spark, "dim_client", at), shown)
    return found


def counted(tables: dict[str, Tallied]) -> DataFrame:
    """(asset, actual_rows) from the tallies."""
    return _stacked(
        [
            table.totals().agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("actual_rows"))
            .select(F.lit(name).alias("asset"), "actual_rows")
            for name, table in tables.items()
        ]
    )


def feed_balance(spark: SparkSession, lake: Lake, feed: Feed) -> DataFrame:
    """raw = clean + quarantined + suppressed: the raw table is scanned once, the others by their tallies."""
    tables = tallied_tables(spark, lake)
    held = counted({"clean": tables[feed.clean_table], "quarantined": tables[feed.quarantine_table]})
    return balanced(raw_and_suppressed(lake.raw(spark, feed), feed), held, feed)


def agreement(spark: SparkSession, left: Lake, right: Lake) -> DataFrame:
    """(asset, left_rows, right_rows, only_left, only_right) for every table of two lakes, copies counted.

    Parts whose tallies agree are taken as equal and not read: of clean events, the days that differ are
    opened, of clean profiles the buckets. Tables without tallies are compared row by row. Lineage is
    left out, as it tells when the rows came in.
    """
    sides = tallied_tables(spark, left), tallied_tables(spark, right)
    both = sorted(sides[0].keys() & sides[1].keys())
    # Each table asks for the names of its differing parts; these small jobs run side by side.
    with ThreadPoolExecutor() as pool:
        results = list(pool.map(lambda name: _compared(sides[0][name], sides[1][name]), both))
    compared = [result.select(F.lit(name).alias("asset"), "*") for name, result in zip(both, results)]
    others = left.tables(spark), right.tables(spark)
    for name in sorted(others[0].keys() - set(both)):
        pair = (_without_lineage(side[name]) for side in others)
        compared.append(differences(*pair).select(F.lit(name).alias("asset"), "*"))
    return _stacked(compared)


def differing_parts(left: Tallied, right: Tallied) -> DataFrame:
    """(part, left_rows, right_rows, same): the parts of both sides by their tallies."""
    a = left.totals().select(PART, F.col("row_count").alias("left_rows"), F.col("digest").alias("_l"))
    b = right.totals().select(PART, F.col("row_count").alias("right_rows"), F.col("digest").alias("_r"))
    same = F.col("left_rows").eqNullSafe(F.col("right_rows")) & F.col("_l").eqNullSafe(F.col("_r"))
    return a.join(b, PART, "full_outer").select(PART, "left_rows", "right_rows", same.alias("same"))


def _compared(left: Tallied, right: Tallied) -> DataFrame:
    parts = differing_parts(left, right)
    differ = parts.where(~F.col("same")).select(PART)
    alike = parts.where("same").agg(F.coalesce(F.sum("left_rows"), F.lit(0)).alias("n")).select(
        F.col("n").alias("left_rows"), F.col("n").alias("right_rows"),
        F.lit(0).cast("long").alias("only_left"), F.lit(0).cast("long").alias("only_right"),
    )
    named = [row[PART] for row in differ.limit(MOST_PARTS + 1).collect()]
    if not named:
        return alike
    rows = [_of_parts(side, named, differ) for side in (left, right)]
    both = alike.unionByName(differences(*rows))
    return both.agg(*(F.sum(name).alias(name) for name in alike.columns))


def _of_parts(side: Tallied, named: Sequence[str], differ: DataFrame) -> DataFrame:
    """Rows of the parts that differ; their names as literals prune partitions."""
    part = side.tallies.part
    rows = side.rows
    if part and len(named) <= MOST_PARTS:
        rows = rows.where(part_of(part).isin(list(named)))
    elif part:
        rows = rows.withColumn(PART, part_of(part)).join(differ, PART, "left_semi")
    return _without_lineage(rows.select(*side.tallies.columns))


def _without_lineage(rows: DataFrame) -> DataFrame:
    return rows.drop(*LINEAGE)


def _stacked(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
