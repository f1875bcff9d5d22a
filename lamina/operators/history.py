"""Type 2 history from a change feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.feeds import CLIENT_PROFILES
from lamina.operators.timeline import SLICE_SECONDS, with_next

# Names of the validity columns and of the columns a profile version leaves out.
START, END = "__START_AT", "__END_AT"
PROFILE_KEYS = ("client_id",)
PROFILE_SEQUENCE = "operation_timestamp"
PROFILE_DELETE = "operation = 'DELETE'"
PROFILE_LEFT_OUT = (
    "operation", "_rescued_data", "_ingest_timestamp", "_source_file", "_source_modified",
    "_source_system",
)

# Landed columns in their order, without key and sequence.
PROFILE_TIES = tuple(c for c in CLIENT_PROFILES.types if c not in (*PROFILE_KEYS, PROFILE_SEQUENCE))


def type2_history(
    changes: DataFrame,
    *,
    keys: Sequence[str],
    sequence: str,
    delete_when: str,
    leave_out: Sequence[str] = (),
    tie_breakers: Sequence[str] = (),
    heavy: DataFrame | None = None,
    slice_seconds: int = SLICE_SECONDS,
    piece_rows: int | None = None,
) -> DataFrame:
    """Versions valid in [START, END), END being NULL for the open one.

    Every change ends the version before it; a delete ends it without opening another. Order of
    arrival does not matter. Changes of a key with equal sequence are ordered deletes last, then by
    ``tie_breakers`` (default: all columns); only the last of them gets a version. A change without
    a sequence has no place in the order and is left out.
    """
    tie = F.struct(*(tie_breakers or changes.columns))
    ranked = changes.where(F.col(sequence).isNotNull()).withColumns(
        {"_delete": F.expr(f"coalesce({delete_when}, false)"), "_tie": tie}
    )
    if heavy is None:
        # One shuffle: look one change ahead. All but the last of a tie come out with zero length.
        in_order = Window.partitionBy(*keys).orderBy(sequence, "_delete", "_tie")
        spans = ranked.withColumn(END, F.lead(sequence).over(in_order))
    else:
        # Only the last of a tie goes on; Spark drops the others before the shuffle already.
        last = Window.partitionBy(*keys, sequence).orderBy(F.desc("_delete"), F.desc("_tie"))
        single = ranked.withColumn("_place", F.row_number().over(last)).where("_place = 1").drop("_place")
        spans = with_next(single, keys, sequence, END, heavy, slice_seconds, piece_rows)
    is_version = ~F.col("_delete") & (F.col(END).isNull() | (F.col(END) > F.col(sequence)))
    kept = [name for name in changes.columns if name not in leave_out]
    return spans.where(is_version).select(*kept, F.col(sequence).alias(START), END)


def profile_history(changes: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Profile versions from the clean profile changes.

    Ties are settled by the landed columns alone, so every build of the same files agrees.
    """
    return type2_history(
        changes,
        keys=PROFILE_KEYS,
        sequence=PROFILE_SEQUENCE,
        delete_when=PROFILE_DELETE,
        leave_out=PROFILE_LEFT_OUT,
        tie_breakers=PROFILE_TIES,
        heavy=heavy,
    )


def overlapping_versions(
    history: DataFrame, keys: Sequence[str] = PROFILE_KEYS, heavy: DataFrame | None = None
) -> DataFrame:
    """(key, start) of versions that reach past the next one or share their start.

    Empty for a sound history. Checking neighbours in start order is enough: if every version ends
    before the next begins, no two of them overlap.
    """
    forever = F.lit("9999-12-31").cast("timestamp")
    starts = history.groupBy(*keys, START).agg(
        F.count(F.lit(1)).alias("_versions"), F.max(F.coalesce(END, forever)).alias("_reach")
    )
    ahead = with_next(starts, keys, START, "_next_start", heavy)
    return ahead.where(
        (F.col("_versions") > 1) | (F.col("_reach") > F.col("_next_start"))
    ).select(*keys, START)
