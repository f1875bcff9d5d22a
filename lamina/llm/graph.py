"""Stored intermediate tables and connected components of links."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.session import shared_folder


#: Spark removes a query's shuffle files when it ends, not when the driver next happens to collect its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends here and survives lost executors.

    Shuffles of the write are removed with it, so disk holds those of one step at a time.
    """
    spark = df.sparkSession
    folder, before = shared_folder(spark, label), spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        df.write.parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(folder)


def buckets(df: DataFrame) -> int:
    """How many buckets keys are dealt into: they follow the session's shuffle partitions."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for all nodes of links (a, b).

    Alternating large and small stars: each step links neighbours to the smallest one seen, so the
    number of steps grows with the logarithm of the longest path. Before each step every batch of rows
    is joined up by itself, which takes most of the length out of paths without a shuffle. Nodes with
    very many links are only reduced by a minimum, which combines before its shuffle. Null ends are
    left out.
    """
    pairs = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    pairs = _shortened(stored(pairs, "links"))
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, F.col("v") > F.col("u"))
        small = stored(_star(large, F.lit(True)), "links")
        state = small.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            return small.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                small.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        pairs, before = _shortened(small), state


def _shortened(pairs: DataFrame) -> DataFrame:
    """Links of each batch of rows replaced by links to the smallest node the batch connects."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parent: dict[int, int] = {}

            def root(node: int) -> int:
                while (above := parent.setdefault(node, node)) != node:
                    parent[node] = parent.setdefault(above, above)
                    node = above
                return node

            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                a, b = root(u), root(v)
                parent[max(a, b)] = min(a, b)
            found = [(node, root(node)) for node in list(parent)]
            found = [(node, least) for node, least in found if node != least]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in found], pa.int64()), pa.array([m for _, m in found], pa.int64())], ["u", "v"]
            )

    return pairs.mapInArrow(run, "u long, v long")


def _star(pairs: DataFrame, moved) -> DataFrame:
    """Links every chosen neighbour, and the node itself, to the smallest node around it."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = pairs.where(moved).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return joined.unionByName(own).where("u > v").distinct()
