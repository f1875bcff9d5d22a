"""Catalog names for the tables of a lake."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from lamina.feeds import FEEDS
from lamina.operators.star import FACT_GROUP, FACT_MEASURES, FACT_TYPES
from lamina.sources.lake import FACT, Lake, Publication
from lamina.sources.log_table import NO_BASE, LogTable
from lamina.sources.tables import TABLES, Namespace, batches, exists


def table_sources(spark: SparkSession, lake: Lake) -> dict[str, str]:
    """SQL text of every table that has been written, as of the last publication."""
    at = lake.last_publication(spark)
    sources = {}
    for feed in FEEDS:
        sources[feed.raw_table] = (lake.raw_path(feed), _listed(feed.raw_schema.names, lake.raw_path(feed)))
        log, names = lake.arrivals_log(feed), feed.typed_schema.names
        upto = log.last(spark)
        text = _listed(names, log.rows_path, "accepted = 'true'")
        if any(number <= upto for number in batches(spark, log.keys_path)):
            text = log.sql(names, upto, where="accepted = 'true'")
        sources[feed.clean_table] = (log.rows_path, text)
        columns = lake.quarantined(spark, feed).columns
        sources[feed.quarantine_table] = (lake.quarantine_path(feed), _listed(columns, lake.quarantine_path(feed)))
    if at:
        history, clients, fact = lake.history_log, lake.dim_client_log(spark), lake.fact_log
        sources["client_profile_history"] = (history.rows_path, history.sql(history.schema.names, at.history, at.history_base))
        names = clients.schema.names
        text = _listed(names, clients.rows_path, f"batch <= {at.publication}")
        if batches(spark, clients.keys_path):
            text = clients.sql(names, at.publication, at.dim_client_base)
        sources["dim_client"] = (clients.rows_path, text)
        folder = lake.dim_campaign_path(at.dim_campaign_at)
        sources["dim_campaign"] = (folder, _listed(lake.published(spark, "dim_campaign").columns, folder))
        sources[FACT] = (fact.rows_path, fact_sql(fact, at))
    return {name: text for name, (folder, text) in sources.items() if exists(spark, folder)}


def _listed(columns: Sequence[str], folder: str, where: str = "true") -> str:
    names = ", ".join(f"`{column}`" for column in columns)
    return f"SELECT {names} FROM parquet.`{folder}` WHERE {where}"


def fact_sql(log: LogTable, at: Publication) -> str:
    """The fact with its differences added up."""
    names = list(FACT_TYPES)
    parts = [_listed(names, log.rows_path, f"batch > {at.fact_base} AND batch <= {at.publication}")]
    if at.fact_base > NO_BASE:
        parts.append(_listed(names, log.base_path(at.fact_base)))
    groups = ", ".join(FACT_GROUP)
    sums = ", ".join(f"sum({name}) AS {name}" for name in FACT_MEASURES)
    added = f"SELECT {groups}, {sums} FROM ({' UNION ALL '.join(parts)}) AS parts GROUP BY {groups}"
    shown = ", ".join("true AS synthetic_record" if name == "synthetic_record" else name for name in names)
    return f"SELECT {shown} FROM ({added}) AS total WHERE event_count > 0"


def _quoted(text: str) -> str:
    """The text as a SQL string."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def name_tables(spark: SparkSession, lake: Lake, namespace: Namespace) -> list[str]:
    """Point the catalog names at this generation, with comment and properties.

    The names are views over the folders. Replacing a view is atomic, so readers go from one
    complete generation to the next. The schemas must exist. Tables without any file are left out:
    nothing tells their column types yet.
    """
    named = []
    for name, text in table_sources(spark, lake).items():
        info = TABLES[name]
        pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in info.properties.items())
        try:
            spark.sql(
                f"CREATE OR REPLACE VIEW {namespace.table(info.layer, name)}"
                f" COMMENT {_quoted(info.comment)} TBLPROPERTIES ({pairs})"
                f" AS {text}"
            )
        except AnalysisException as problem:
            if problem.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
        else:
            named.append(name)
    return named
