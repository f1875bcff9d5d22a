"""Row counts and digests of stored tables, kept up batch by batch, so that checks need not read the tables.

A tally holds for each part of a table (a bucket, a day, or the whole table) how many rows it has and the sum of
their hashes. Both add up: a batch writes one small row per part, of what it added minus what it superseded. Tables
with equal sums hold the same rows, however these are spread over files and batches; copies count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.sources.tables import batches, read_or_empty

# How and when a row came in; two lakes of the same files differ in these.
LINEAGE = ("_ingest_timestamp", "_source_file", "_source_modified")
#: Room for 10**18 rows of 64-bit hashes.
DIGEST = T.DecimalType(38, 0)
PART, TERM, WHOLE, NO_VALUE = "part", "term", "", "null"


def row_term(columns: Sequence[str]) -> Column:
    """Hash of a row without lineage. Hashing passes over NULLs, so which columns are NULL is hashed as well."""
    names = sorted(name for name in columns if name not in LINEAGE)
    return F.xxhash64(*names, *(F.isnull(name) for name in names)).alias(TERM)


def part_of(column: str | None) -> Column:
    """The part a row belongs to as text; on a partition column this condition prunes folders."""
    value = F.lit(WHOLE) if column is None else F.coalesce(F.col(column).cast("string"), F.lit(NO_VALUE))
    return value.alias(PART)


def _count() -> Column:
    return F.count(F.lit(1)).alias("row_count")


def _digest() -> Column:
    return F.coalesce(F.sum(F.col(TERM).cast("decimal(20,0)")), F.lit(0)).cast(DIGEST).alias("digest")


@dataclass(frozen=True)
class Tallies:
    """The tally of a table with ``columns`` whose batches are partitioned by ``part``, if by anything."""

    path: str
    columns: tuple[str, ...]
    part: str | None = None

    schema = T.StructType().add(PART, "string").add("row_count", "long").add("digest", DIGEST).add("batch", "long")

    def terms(self, rows: DataFrame) -> DataFrame:
        """(part, term) of table rows."""
        return rows.select(part_of(self.part), row_term(self.columns))

    def recounted(self, rows: DataFrame) -> DataFrame:
        """(part, row_count, digest) of table rows."""
        return self.terms(rows).groupBy(PART).agg(_count(), _digest())

    def record(self, batch: int, added: DataFrame, removed: DataFrame | None = None) -> None:
        """Tally one batch from the (part, term) of its rows and of the rows they supersede.

        ``added`` should be read from the batch as written: a count taken on the way through a shuffle would be
        too high when tasks before the shuffle are run again. A repeated batch overwrites its own folder.
        """
        tally = added.groupBy(PART).agg(_count(), _digest())
        if removed is not None:
            gone = removed.groupBy(PART).agg(_count(), _digest())
            gone = gone.select(PART, *((-F.col(c)).cast(tally.schema[c].dataType).alias(c) for c in ("row_count", "digest")))
            tally = _added_up(tally.unionByName(gone))
        tally.coalesce(1).write.mode("overwrite").parquet(self._folder(batch))

    def write_observed(self, rows: DataFrame, target: str, batch: int) -> None:
        """Write a batch that takes no shuffle and tally it on the way; the result of a task counts once."""
        seen = Observation()
        watched = rows.withColumn(TERM, row_term(self.columns)).observe(seen, _count(), _digest()).drop(TERM)
        watched.write.mode("overwrite").parquet(target)
        found = seen.get
        row = rows.sparkSession.range(1).select(
            F.lit(WHOLE).alias(PART), F.lit(found["row_count"]).cast("long").alias("row_count"),
            F.lit(str(found["digest"])).cast(DIGEST).alias("digest"),
        )
        row.coalesce(1).write.mode("overwrite").parquet(self._folder(batch))

    def _folder(self, batch: int) -> str:
        return f"{self.path}/batch={batch}"

    def covers(self, spark: SparkSession, known: Sequence[int]) -> bool:
        """Whether every batch of the table has its tally; after a failure between two writes the last has none."""
        return set(known) <= set(batches(spark, self.path))

    def totals(self, spark: SparkSession, upto: int) -> DataFrame:
        """(part, row_count, digest) as of batch ``upto``; parts without rows are left out."""
        stored = read_or_empty(spark, self.path, self.schema).where(F.col("batch") <= upto)
        return _added_up(stored).where((F.col("row_count") != 0) | (F.col("digest") != 0))


def _added_up(tallies: DataFrame) -> DataFrame:
    return tallies.groupBy(PART).agg(
        F.sum("row_count").alias("row_count"), F.sum("digest").cast(DIGEST).alias("digest")
    )
