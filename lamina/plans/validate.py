"""The data contract checked on stored tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from lamina.operators.contract import check_counts, evidence, identifier_leaks, require_pass
from lamina.sources.lake import FACT, Lake
from lamina.sources.tables import TABLES, Namespace

PRIVATE = ("dim_client", FACT)


def named_tables(spark: SparkSession, names: Namespace) -> dict[str, DataFrame]:
    """The catalog's tables by their short names; those that are not there are left out."""
    found = {name: names.table(info.layer, name) for name, info in TABLES.items()}
    return {name: spark.table(full) for name, full in found.items() if spark.catalog.tableExists(full)}


def validate(
    spark: SparkSession,
    tables: Lake | Namespace,
    expected: Mapping[str, int],
    min_rows: Mapping[str, int],
    environment: str,
    path: str,
) -> dict:
    """Count the stored tables, look for identifiers, write the evidence to ``path``, raise on FAIL.

    ``tables`` is a lake, or the names its tables have in the catalog. ``expected`` holds exact
    counts known from elsewhere, ``min_rows`` least counts; a table named in either must be there.
    """
    names = tables if isinstance(tables, Namespace) else Namespace.from_conf(spark)
    stored = named_tables(spark, tables) if isinstance(tables, Namespace) else tables.tables(spark)
    nothing = {"none": spark.range(0).selectExpr("'' AS none")}
    rows = spark.createDataFrame(list(expected.items()), "asset string, expected_rows long")
    record = evidence(
        check_counts(stored, rows, min_rows),
        identifier_leaks({name: stored[name] for name in PRIVATE if name in stored} or nothing),
        stored,
        environment,
        names.catalog,
        (names.bronze_schema, names.silver_schema, names.gold_schema),
    )
    return require_pass(record, path)
