"""Log-structured tables: a batch appends what it rebuilt, readers take the newest rebuild of each key.

A batch writes two folders: its rows, and the keys it rebuilt, those left without rows included. A row
counts unless a later batch rebuilt its key. So a batch writes in proportion to what changed, never to the
table, and older states stay readable. A base holds all live rows up to some batch, so that readers
need not go through a long log; which base to read is told by whoever publishes the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.sources.tables import batches, read_or_empty, remove

#: A log is compacted when what follows its first part exceeds this share of it, or so many batches.
MOST_SHARE, MOST_BATCHES = 0.25, 16
NO_BASE = -1


def with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch", T.LongType())])


def _span(rows: DataFrame, after: int, upto: int | None) -> DataFrame:
    rows = rows if after == NO_BASE else rows.where(F.col("batch") > after)
    return rows if upto is None else rows.where(F.col("batch") <= upto)


@dataclass(frozen=True)
class LogTable:
    """Rows with ``schema``, of which all that share ``keys`` are rebuilt together.

    ``key_columns`` are further columns kept beside the keys.
    """

    root: str
    schema: T.StructType
    keys: tuple[str, ...]
    key_columns: tuple[tuple[str, str], ...] = ()
    rows_name: str = "rows"

    @property
    def rows_path(self) -> str:
        return f"{self.root}/{self.rows_name}"

    @property
    def keys_path(self) -> str:
        return f"{self.root}/{self.rows_name}_rebuilt"

    def base_path(self, base: int) -> str:
        return f"{self.root}/{self.rows_name}_base/upto={base}"

    @property
    def key_schema(self) -> T.StructType:
        fields = [self.schema[name] for name in self.keys]
        return reduce(lambda schema, item: schema.add(*item), self.key_columns, T.StructType(fields))

    def append(self, rows: DataFrame, rebuilt: DataFrame | None, batch: int, partition_by: Sequence[str] = ()) -> None:
        """Write one batch; a repeated batch overwrites its own folders and nothing else."""
        if partition_by:
            rows = rows.hint("rebalance", *partition_by)
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{self.rows_path}/batch={batch}")
        if rebuilt is not None:
            rebuilt.select(self.key_schema.names).write.mode("overwrite").parquet(f"{self.keys_path}/batch={batch}")

    def last(self, spark: SparkSession) -> int:
        return max(batches(spark, self.rows_path), default=-1)

    def log(self, spark: SparkSession, after: int = NO_BASE, upto: int | None = None) -> DataFrame:
        """Rows as written by the batches in (after, upto], superseded ones included."""
        return _span(read_or_empty(spark, self.rows_path, with_batch(self.schema)), after, upto)

    def rebuilt(self, spark: SparkSession, after: int = NO_BASE, upto: int | None = None) -> DataFrame:
        """Keys rebuilt by the batches in (after, upto], once per batch."""
        return _span(read_or_empty(spark, self.keys_path, with_batch(self.key_schema)), after, upto)

    def live(self, spark: SparkSession, upto: int | None = None, base: int = NO_BASE) -> DataFrame:
        """The table as of batch ``upto`` (default: the last), with the batch each row comes from.

        Older rows are cut down by an anti join with the keys rebuilt since the base. Each key comes
        once, and as long as they are few Spark broadcasts them: the long side is scanned, not shuffled.
        """
        known = batches(spark, self.rows_path)
        rows = self.log(spark, base, upto)
        upto = max(known, default=-1) if upto is None else upto
        if base > NO_BASE:
            old = spark.read.schema(self.schema).parquet(self.base_path(base))
            rows = old.withColumn("batch", F.lit(base).cast("long")).unionByName(rows)
        later = [n for n in batches(spark, self.keys_path) if base < n <= upto]
        first = min([n for n in known if n <= upto], default=upto) if base == NO_BASE else base
        if not [n for n in later if n > first]:
            return rows
        newest = self.rebuilt(spark, first, upto).groupBy(*(F.col(c).alias(f"_{c}") for c in self.keys))
        newest = newest.agg(F.max("batch").alias("_newest"))
        same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in self.keys))
        return rows.join(newest, same & (F.col("batch") < F.col("_newest")), "left_anti")

    def sql(self, columns: Sequence[str], upto: int, base: int = NO_BASE, where: str = "true") -> str:
        """The same table as SQL text, for a view."""
        shown = ", ".join(f"`{c}`" for c in dict.fromkeys([*columns, *self.keys]))
        span = f"batch > {base} AND batch <= {upto}"
        parts = [f"SELECT {shown}, batch FROM parquet.`{self.rows_path}` WHERE {span} AND {where}"]
        if base > NO_BASE:
            parts.append(f"SELECT {shown}, {base} AS batch FROM parquet.`{self.base_path(base)}` WHERE {where}")
        rows = " UNION ALL ".join(parts)
        names = ", ".join(f"`{c}`" for c in self.keys)
        same = " AND ".join(f"r.`{c}` <=> k.`{c}`" for c in self.keys)
        wanted = ", ".join(f"r.`{c}`" for c in columns)
        return (
            f"SELECT {wanted} FROM ({rows}) AS r LEFT ANTI JOIN (SELECT {names}, max(batch) AS newest"
            f" FROM parquet.`{self.keys_path}` WHERE {span} GROUP BY {names}) AS k ON {same} AND r.batch < k.newest"
        )

    def is_long(self, spark: SparkSession, upto: int, base: int = NO_BASE) -> bool:
        """Whether reading the log costs so much more than its first part that it should be compacted."""
        later = [n for n in batches(spark, self.rows_path) if base < n <= upto]
        if base == NO_BASE:
            later = later[1:]
        if len(later) < 2:
            return False
        if len(later) > MOST_BATCHES:
            return True
        # Row counts come from the files' footers.
        since = self.log(spark, later[0] - 1, upto).count()
        first = self.log(spark, base, later[0] - 1) if base == NO_BASE else spark.read.schema(self.schema).parquet(self.base_path(base))
        return since > MOST_SHARE * first.count()

    def write_base(self, rows: DataFrame, upto: int, partition_by: Sequence[str] = ()) -> None:
        """All live rows up to a batch. Readers learn of it only when its number is published."""
        rows = rows.select(self.schema.names)
        if partition_by:
            rows = rows.hint("rebalance", *partition_by)
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(self.base_path(upto))

    def expire(self, spark: SparkSession, base: int) -> None:
        """Remove what no reader of ``base`` or a later one needs: batches up to it, and other bases before it."""
        if base == NO_BASE:
            return
        for path in (self.rows_path, self.keys_path):
            for number in batches(spark, path):
                if number <= base:
                    remove(spark, f"{path}/batch={number}")
        for number in batches(spark, f"{self.root}/{self.rows_name}_base", "upto="):
            if number < base:
                remove(spark, self.base_path(number))

