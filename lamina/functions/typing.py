"""Text to timestamps and dates without failing on bad text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def typed(df: DataFrame, timestamps: Sequence[str] = (), dates: Sequence[str] = ()) -> DataFrame:
    """Retype the named text columns in place; text that does not parse becomes NULL.

    Works on batch and streaming frames alike, as it is a projection. The try_ forms matter: under
    ANSI mode (the default) the plain parsers fail the job on the first bad value.
    """
    parsed = {name: F.try_to_timestamp(F.col(name)) for name in timestamps}
    parsed |= {name: F.try_to_date(F.col(name)) for name in dates}
    return df.withColumns(parsed) if parsed else df


def activity_date(at: Column) -> Column:
    """Calendar day of a timestamp in the session time zone (pinned to UTC)."""
    return F.to_date(at)
