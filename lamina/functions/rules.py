"""Named data-quality rules as Spark expressions.

A rule is SQL text over the columns of a typed feed. Three-valued logic is closed off at one
place: a rule whose predicate evaluates to NULL has failed.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = ", "


@dataclass(frozen=True)
class RuleSet:
    """Rules in declaration order; that order is also the order of the failure list."""

    predicates: Mapping[str, str]

    def __iter__(self) -> Iterator[str]:
        return iter(self.predicates)

    def holds(self, name: str) -> Column:
        return F.expr(f"coalesce(({self.predicates[name]}), false)")

    def accepted(self) -> Column:
        """TRUE when every rule holds, FALSE otherwise, never NULL."""
        return F.expr(" AND ".join(f"coalesce(({p}), false)" for p in self.predicates.values()))

    def rejected(self) -> Column:
        return ~self.accepted()

    def failures(self) -> Column:
        """Names of the failed rules as one text; concat_ws leaves out the NULLs of rules that hold."""
        return F.concat_ws(
            SEPARATOR, *(F.when(~self.holds(name), F.lit(name)) for name in self.predicates)
        )

    def failure_counts(self, typed: DataFrame) -> DataFrame:
        """(rule, failed_rows) for the whole input: one scan, one aggregate row, then unpivoted."""
        totals = typed.agg(*(F.count_if(~self.holds(name)).alias(name) for name in self.predicates))
        return totals.unpivot([], list(self.predicates), "rule", "failed_rows")


def matches(column: str, pattern: str) -> str:
    return f"{column} RLIKE '{pattern}'"


def among(column: str, words: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{word}'" for word in words)
    return f"{column} IN ({listed})"
