"""Fingerprints of the identities each batch took in, so that a later batch knows which old files to read.

Beside a table written batch by batch stands a narrow one: a 64-bit hash of the identity and the value of
the partition column that its row went to. New rows are looked up there first. Only partitions that hold a
row with one of their fingerprints are read for the exact comparison; equal hashes of different identities
cost a read and change no result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.sources.tables import batches, read_or_empty

#: Beyond so many partitions the filter names batches only: more is read, and the result is the same.
MOST_PLACES = 10_000
FINGERPRINT, PLACE = "fingerprint", "place"


@dataclass(frozen=True)
class Members:
    """The index of a table with ``identity`` whose batches are partitioned by ``place``, if by anything."""

    path: str
    identity: tuple[str, ...]
    place: T.StructField | None = None

    @property
    def schema(self) -> T.StructType:
        fields = [T.StructField(FINGERPRINT, T.LongType())]
        if self.place:
            fields.append(T.StructField(PLACE, self.place.dataType))
        return T.StructType([*fields, T.StructField("batch", T.LongType())])

    @property
    def fingerprint(self) -> Column:
        """NULL identities have a fingerprint as well."""
        return F.xxhash64(*self.identity).alias(FINGERPRINT)

    def record(self, rows: DataFrame, batch: int) -> None:
        """Index one batch; a repeated batch overwrites its own folder."""
        shown = [self.fingerprint, *([F.col(self.place.name).alias(PLACE)] if self.place else [])]
        rows.select(*shown).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def where_met(self, rows: DataFrame, known: Sequence[int]) -> Column:
        """Condition on partition columns: where, in the batches ``known``, identities of ``rows`` may stand.

        Batches that have no index yet may hold any identity. Fingerprints are all that is scanned, and
        shuffled only if those of ``rows`` are too many to be broadcast. To the driver come names of
        partitions, never identities.
        """
        spark = rows.sparkSession
        indexed = set(batches(spark, self.path)) & set(known)
        whole = set(known) - indexed
        stored = read_or_empty(spark, self.path, self.schema).where(F.col("batch").isin(sorted(indexed)))
        found = stored.join(rows.select(self.fingerprint), FINGERPRINT, "left_semi")
        if self.place:
            found = found.select("batch", _named("batch", PLACE).alias("name")).distinct()
            named = found.limit(MOST_PLACES + 1).collect()
            if len(named) <= MOST_PLACES:
                some = _named("batch", self.place.name).isin([row.name for row in named])
                return F.col("batch").isin(sorted(whole)) | some
        # One row per batch.
        whole |= {row.batch for row in found.select("batch").distinct().collect()}
        return F.col("batch").isin(sorted(whole))


def _named(batch: str, place: str) -> Column:
    """One partition as text, so that a list of them is one IN and no tree of conditions."""
    return F.concat_ws(":", F.col(batch), F.coalesce(F.col(place).cast("string"), F.lit("null")))


def earlier_copies(rows: DataFrame, members: Members, live: DataFrame, known: Sequence[int]) -> DataFrame:
    """The rows of ``live`` that identities of ``rows`` have to be compared with, and some others.

    The condition is on partition columns alone, so files of other partitions are not opened.
    """
    return live.where(members.where_met(rows, known))
