"""Finding the few keys that hold too many rows for one task.

The result only decides *how* rows are partitioned, never *which* rows are kept: every operator
that takes ``heavy`` gives the same output for any key list, an empty or stale one included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.session import shared_folder

MIN_ROWS = 1_000_000
MAX_KEYS = 100_000


def rows_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Reads the key columns only and combines before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))


def heavy_keys(
    df: DataFrame, keys: Sequence[str], min_rows: int = MIN_ROWS, max_keys: int = MAX_KEYS
) -> DataFrame:
    """Keys holding more than ``min_rows`` rows and more than 1/``max_keys`` of all rows.

    ``rows`` counts a key's rows and ``pieces`` says into how many parts of that size it would have to be cut. The second
    condition bounds the result by arithmetic: fewer than ``max_keys`` keys can each hold more
    than 1/``max_keys`` of the rows. That is what makes it safe to broadcast.
    """
    counted = rows_per_key(df, keys)
    total = counted.agg(F.sum("_rows")).scalar()
    bearable = F.greatest(F.lit(min_rows), F.ceil(total / F.lit(max_keys)))
    return counted.where(F.col("_rows") > bearable).select(
        *keys, F.ceil(F.col("_rows") / bearable).cast("int").alias("pieces"), F.col("_rows").alias("rows")
    )


def heavy_or_none(
    df: DataFrame, keys: Sequence[str], min_rows: int = MIN_ROWS, max_keys: int = MAX_KEYS
) -> DataFrame | None:
    """The heavy keys, or None when no key is large, so that even data keeps its simpler plan.

    Runs one counting job now and writes the list to the shared folder: it is used in several places,
    and counting anew for each would cost more than all else.
    """
    listed, folder = heavy_keys(df, keys, min_rows, max_keys), shared_folder(df.sparkSession, "heavy")
    listed.write.parquet(folder)
    stored = df.sparkSession.read.schema(listed.schema).parquet(folder)
    return None if stored.isEmpty() else stored


def only_heavy(df: DataFrame, heavy: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(F.broadcast(heavy.select(*keys)), list(keys), "left_semi")


def without_heavy(df: DataFrame, heavy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The other rows, those with a NULL key included."""
    return df.join(F.broadcast(heavy.select(*keys)), list(keys), "left_anti")
