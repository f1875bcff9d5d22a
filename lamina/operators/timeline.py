"""Neighbour lookups along a key's time line: next change, and version in force at a time.

Even keys are one piece. Keys listed in ``heavy`` (see ``functions.skew``) are cut into pieces of about
``piece_rows`` rows at quantiles of their times, so that no task holds a whole heavy key; what a piece needs
to know about its neighbours travels as a few extra rows. A list may bring its cuts in a column ``_cuts``. Any
list and any cuts give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions.skew import MIN_ROWS, only_heavy
from lamina.session import shared_folder

SLICE_SECONDS = 0
#: Times looked at per piece to find the quantiles, and a bound on the pieces of all keys together.
SAMPLES, MOST_PIECES = 64, 100_000


def time_cuts(
    times: DataFrame, heavy: DataFrame, keys: Sequence[str], at: str,
    piece_rows: int | None = None, slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """(keys, _cuts array<timestamp>): where heavy keys are cut, rising; a time may stand there repeatedly.

    A time that holds a whole piece or more gets a cut for each, so its rows can be dealt over several
    pieces. Equal times are counted before anything is shuffled, then every time with many rows and a
    share of the others, chosen by a hash, stand for all. ``piece_rows`` is the size wanted; without it the
    list's own ``rows`` and ``pieces`` say how finely a key is cut. There are fewer cuts than MOST_PIECES and
    one for each key, however many rows there are, so the list is safe to broadcast. ``slice_seconds`` rounds
    cuts down to multiples of that many seconds. The list is written to the shared folder: a
    task that is run again sees the same cuts.
    """
    placed = times.select(*keys, F.col(at).cast("timestamp").alias("_at")).where("_at IS NOT NULL")
    if piece_rows is None and {"rows", "pieces"} <= set(heavy.columns):
        sized = F.broadcast(heavy.select(*keys, (F.col("rows") / F.col("pieces")).alias("_size")))
        counted = placed.join(sized, list(keys)).groupBy(*keys, "_at").agg(
            F.count(F.lit(1)).alias("_n"), F.first("_size").alias("_size")
        )
    else:
        counted = only_heavy(placed, heavy, keys).groupBy(*keys, "_at").agg(F.count(F.lit(1)).alias("_n"))
        total = counted.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
        size = F.greatest(F.lit(piece_rows or MIN_ROWS), F.ceil(total / F.lit(MOST_PIECES)))
        counted = counted.withColumn("_size", size.cast("double"))
    every = F.greatest(F.lit(1), F.floor(F.col("_size") / F.lit(SAMPLES)))
    chosen = (F.col("_n") >= every) | (F.pmod(F.xxhash64(*keys, "_at"), every) < F.col("_n"))
    weight = F.greatest(F.col("_n"), every)
    per_key = Window.partitionBy(*keys)
    so_far = per_key.orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lined = counted.where(chosen).select(*keys, "_at", "_size", weight.alias("_n")).withColumns(
        {"_sum": F.sum("_n").over(so_far), "_all": F.sum("_n").over(per_key)}
    )
    pieces = F.ceil(F.col("_all") / F.col("_size"))

    def passed(rows: Column) -> Column:
        return F.least(F.floor(rows * pieces / F.col("_all")), pieces - 1)

    cut = F.col("_at")
    if slice_seconds:
        cut = F.timestamp_seconds(F.floor(F.unix_micros(cut) / F.lit(slice_seconds * 1_000_000)) * slice_seconds)
    repeats = (passed(F.col("_sum")) - passed(F.col("_sum") - F.col("_n"))).cast("int")
    cuts = lined.where(repeats > 0).select(*keys, F.array_repeat(cut, repeats).alias("_cut"))
    listed = cuts.groupBy(*keys).agg(F.array_sort(F.flatten(F.collect_list("_cut"))).alias("_cuts"))
    folder = shared_folder(times.sparkSession, "cuts")
    listed.write.parquet(folder)
    return times.sparkSession.read.schema(listed.schema).parquet(folder)


def _cuts_of(times: DataFrame, heavy: DataFrame, keys: Sequence[str], at: str, piece_rows: int | None, slice_seconds: int) -> DataFrame:
    """The cuts that a list of heavy keys brings along, else those of the times at hand."""
    if "_cuts" in heavy.columns:
        return heavy.select(*keys, "_cuts")
    return time_cuts(times, heavy, keys, at, piece_rows, slice_seconds)


def _cuts_before(at: Column, upto: bool = False) -> Column:
    """How many cuts are before a time (or at it, with ``upto``), by binary search; 0 for keys without cuts."""
    cuts = F.col("_cuts")
    begin = F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high"))

    def step(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        here = F.get(cuts, middle)
        passed = (here <= at) if upto else (here < at)
        open_ = state["low"] < state["high"]
        return F.struct(
            F.when(open_ & passed, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(open_ & ~passed, middle).otherwise(state["high"]).alias("high"),
        )

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(cuts) + 1)).cast("int"))
    found = F.aggregate(steps, begin, step, lambda state: state["low"])
    return F.when(cuts.isNull() | at.isNull(), F.lit(0)).otherwise(found)


def _with_cuts(df: DataFrame, cuts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(F.broadcast(cuts), list(keys), "left")


def with_next(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    into: str,
    heavy: DataFrame | None = None,
    slice_seconds: int = SLICE_SECONDS,
    piece_rows: int | None = None,
) -> DataFrame:
    """Add the next later ``at`` of the same key. (key, at) must be unique.

    Each piece also gets the first time of the piece after it.
    """
    if heavy is None:
        return df.withColumn(into, F.lead(at).over(Window.partitionBy(*keys).orderBy(at)))
    cuts = _cuts_of(df, heavy, keys, at, piece_rows, slice_seconds)
    cut = _with_cuts(df, cuts, keys).withColumn("_piece", _cuts_before(F.col(at), upto=True))
    per_key = Window.partitionBy(*keys).orderBy("_piece")
    heads = (
        cut.where(F.col("_cuts").isNotNull())
        .groupBy(*keys, "_piece")
        .agg(F.min(at).alias(at))
        .withColumn("_piece", F.lag("_piece").over(per_key))
        .where(F.col("_piece").isNotNull())
        .withColumn("_is_head", F.lit(True))
    )
    within = Window.partitionBy(*keys, "_piece").orderBy(at)
    return (
        cut.drop("_cuts").withColumn("_is_head", F.lit(False))
        .unionByName(heads, allowMissingColumns=True)
        .withColumn(into, F.lead(at).over(within))
        .where(~F.col("_is_head"))
        .drop("_is_head", "_piece")
    )


def attach_effective(
    events: DataFrame,
    versions: DataFrame,
    *,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    heavy: DataFrame | None = None,
    slice_seconds: int = SLICE_SECONDS,
    piece_rows: int | None = None,
) -> DataFrame:
    """Inner as-of join: each event with the version whose [start, end) holds its time.

    An open version has a NULL end. Versions of one key must not overlap. The two sides are laid
    on one time line per key and the latest start is carried forward, so the cost is a sort, never
    events times versions as in an equality join with the range as a left-over condition.

    Heavy keys are cut into pieces by time, all keys in the same pass over each side. A version goes into
    every piece whose times it covers: versions do not overlap, so a cut adds at most one row. Events
    at a time that is cut repeatedly are dealt over its pieces by a hash.
    """
    versions = versions.select(*keys, start, end)
    if heavy is None:
        return _carry_forward(events, versions, keys, at, start, end)
    times = events.select(*keys, F.col(at).alias("_time")).unionAll(versions.select(*keys, start))
    cuts = _cuts_of(times, heavy, keys, "_time", piece_rows, slice_seconds)
    events_cut, versions_cut = _with_cuts(events, cuts, keys), _with_cuts(versions, cuts, keys)
    low, high = _cuts_before(F.col(at)), _cuts_before(F.col(at), upto=True)
    dealt = low + F.pmod(F.xxhash64(*events.columns), high - low + 1).cast("int")
    whole = F.col("_cuts").isNull()
    events_cut = events_cut.select(*events.columns, F.when(whole, 0).otherwise(dealt).alias("_piece"))
    first = _cuts_before(F.col(start))
    last = F.when(F.col(end).isNull(), F.size("_cuts")).otherwise(_cuts_before(F.col(end)))
    covered = F.when(whole, F.array(F.lit(0))).otherwise(F.sequence(first, F.greatest(first, last)))
    versions_cut = versions_cut.select(*versions.columns, F.explode(covered).alias("_piece"))
    placed = _carry_forward(events_cut, versions_cut, [*keys, "_piece"], at, start, end)
    return placed.drop("_piece")


def _carry_forward(events, versions, parts, at, start, end) -> DataFrame:
    """Walk each part in time order, versions before events at equal times."""
    line = events.withColumn("_is_event", F.lit(True)).unionByName(
        versions.select(
            *parts,
            F.col(start).alias(at),
            F.struct(start, end).alias("_version"),
            F.lit(False).alias("_is_event"),
        ),
        allowMissingColumns=True,
    )
    so_far = (
        Window.partitionBy(*parts)
        .orderBy(at, "_is_event")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = line.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far))
    in_force = F.col(f"_version.{end}").isNull() | (F.col(at) < F.col(f"_version.{end}"))
    return placed.where(
        F.col("_is_event") & F.col("_version").isNotNull() & in_force
    ).select(*events.columns, f"_version.{start}", f"_version.{end}")
