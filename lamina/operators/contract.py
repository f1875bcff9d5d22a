"""Checks on published tables: counts, leaks, conservation, references, equality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.feeds import CLIENT_ID_PATTERN, Feed
from lamina.operators.dedup import ARRIVAL, SYSTEM
from lamina.operators.quality import candidates

# Column names that would give a person away.
IDENTIFIER_COLUMNS = ("client_id", "email", "email_address", "phone", "account_number")


class ContractViolation(AssertionError):
    """A published table does not meet its contract."""


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(asset, actual_rows), one job for all tables; each is reduced to one row before the union."""
    return _stack(
        [
            df.agg(F.count(F.lit(1)).alias("actual_rows")).select(
                F.lit(asset).alias("asset"), "actual_rows"
            )
            for asset, df in tables.items()
        ]
    )


def check_counts(
    tables: Mapping[str, DataFrame], expected: DataFrame, min_rows: Mapping[str, int]
) -> DataFrame:
    """Compare every table with its exact expected count or its least count.

    ``expected`` has (asset, expected_rows) and comes from outside, not from the tables under test.
    All findings are kept; nothing stops at the first. A table that is expected or has a least
    count but is not there fails, with no actual count.
    """
    counts = row_counts(tables)
    pairs = [F.struct(F.lit(a).alias("asset"), F.lit(n).cast("long").alias("min_rows")) for a, n in min_rows.items()]
    none = F.array().cast("array<struct<asset:string,min_rows:bigint>>")
    floors = expected.sparkSession.range(1).select(F.inline(F.array(*pairs) if pairs else none))
    exact = F.col("expected_rows").isNull() | (F.col("actual_rows") == F.col("expected_rows"))
    enough = F.col("min_rows").isNull() | (F.col("actual_rows") >= F.col("min_rows"))
    return (
        counts.join(expected.select("asset", "expected_rows"), "asset", "full")
        .join(floors, "asset", "full")
        .select(
            "asset", "expected_rows", "min_rows", "actual_rows",
            F.when(F.col("actual_rows").isNotNull() & exact & enough, "PASS").otherwise("FAIL").alias("status"),
        )
    )


def identifier_leaks(tables: Mapping[str, DataFrame], pattern: str = CLIENT_ID_PATTERN) -> DataFrame:
    """(asset, column_name, forbidden_name, leaked_values) for every text column.

    Looks at names and, in one pass per table, at values that look like a client id.
    """
    audits = []
    for asset, df in tables.items():
        columns = [name for name, kind in df.dtypes if kind == "string"]
        columns += [c for c in df.columns if c.lower() in IDENTIFIER_COLUMNS and c not in columns]
        found = df.agg(
            *(F.count_if(F.col(c).cast("string").rlike(pattern)).alias(c) for c in columns)
        )
        audits.append(
            found.unpivot([], columns, "column_name", "leaked_values").select(
                F.lit(asset).alias("asset"),
                "column_name",
                F.lower("column_name").isin(*IDENTIFIER_COLUMNS).alias("forbidden_name"),
                "leaked_values",
            )
        )
    return _stack(audits)


def evidence(
    counts: DataFrame,
    leaks: DataFrame,
    tables: Mapping[str, DataFrame],
    environment: str,
    catalog: str = "",
    schemas: Sequence[str] = (),
) -> DataFrame:
    """One row: environment, names, counts per asset, failures, and the overall PASS or FAIL.

    Rows that are not flagged synthetic, in any of ``tables`` that has the flag, fail the run; so
    does having no flagged table at all.
    """
    flagged = [df for df in tables.values() if "synthetic_record" in df.columns]
    synthetic = _stack(
        [counts.sparkSession.range(0 if flagged else 1).select(F.lit(1).cast("long").alias("real_rows"))]
        + [
            df.agg(F.count_if(~F.coalesce("synthetic_record", F.lit(False))).alias("real_rows"))
            for df in flagged
        ]
    ).agg(F.coalesce(F.sum("real_rows"), F.lit(0)).alias("real_rows"))
    by_asset = F.sort_array(F.collect_list(F.struct("asset", "actual_rows")))
    failing = F.collect_list(F.when(F.col("status") == "FAIL", F.col("asset")))
    summary = counts.agg(
        F.map_from_entries(F.filter(by_asset, lambda e: e["actual_rows"].isNotNull())).alias("counts"), F.sort_array(failing).alias("count_failures")
    )
    is_leak = F.col("forbidden_name") | (F.col("leaked_values") > 0)
    leaked = leaks.agg(
        F.sort_array(
            F.collect_list(F.when(is_leak, F.concat_ws(".", "asset", "column_name")))
        ).alias("identifier_leaks")
    )
    leak_list = leaked.scalar()
    real_rows = synthetic.scalar()
    clean_run = (
        (F.size("count_failures") == 0)
        & (F.size("identifier_leaks") == 0)
        & F.coalesce("synthetic_data_only", F.lit(False))
    )
    return summary.select(
        F.lit(environment).alias("environment"),
        F.lit(catalog).alias("catalog"),
        F.lit(",".join(schemas)).alias("schemas"),
        "counts",
        "count_failures",
        leak_list.alias("identifier_leaks"),
        (real_rows == 0).alias("synthetic_data_only"),
    ).select(
        "*",
        F.when(F.size("identifier_leaks") == 0, "PASS").otherwise("FAIL").alias(
            "gold_direct_identifier_check"
        ),
        F.when(clean_run, "PASS").otherwise("FAIL").alias("status"),
    )


def require_pass(record: DataFrame, path: str) -> dict:
    """Write the evidence as JSON, then raise if it says FAIL."""
    record.write.mode("overwrite").json(path)
    stored = record.sparkSession.read.schema(record.schema).json(path)
    outcome = stored.first().asDict(recursive=True)
    if outcome["status"] != "PASS":
        raise ContractViolation(str(outcome))
    return outcome


def manifest(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """(counts_json, contract_sha256): rows per feed as key-sorted JSON text, and its digest."""
    entries = row_counts(feeds).select(
        F.format_string('"%s": %d', "asset", "actual_rows").alias("entry")
    )
    text = F.concat(
        F.lit("{"), F.array_join(F.sort_array(F.collect_list("entry")), ", "), F.lit("}")
    )
    return entries.agg(text.alias("counts_json")).withColumn(
        "contract_sha256", F.sha2("counts_json", 256)
    )


def conservation(
    raw: DataFrame, clean_rows: DataFrame, quarantined: DataFrame, feed: Feed
) -> DataFrame:
    """raw = clean + quarantined + suppressed duplicates, each counted from its own table.

    Suppressed are the rows that pass the rules but are not the first copy of their identity.
    """
    counts = row_counts({"clean": clean_rows, "quarantined": quarantined})
    return balanced(raw_and_suppressed(raw, feed), counts, feed)


def raw_and_suppressed(raw: DataFrame, feed: Feed) -> DataFrame:
    """(raw_rows, suppressed_rows) from one scan of the raw rows."""
    copies = candidates(raw, feed)
    copies = copies.withColumns(
        {"_good": feed.rules.accepted(), "_tie": F.xxhash64(*(c for c in copies.columns if c not in SYSTEM))}
    )
    order = [name for name in ARRIVAL if name in copies.columns]
    per_identity = copies.groupBy(*feed.identity).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if("_good").alias("_good_rows"),
        F.min(F.struct(*order, "_tie", "_good")).getField("_good").alias("_first_good"),
    )
    return per_identity.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("raw_rows"),
        F.coalesce(
            F.sum(F.col("_good_rows") - F.col("_first_good").cast("int")), F.lit(0)
        ).alias("suppressed_rows"),
    )


def balanced(from_raw: DataFrame, counts: DataFrame, feed: Feed) -> DataFrame:
    """The raw side against (asset, actual_rows) of the assets ``clean`` and ``quarantined``."""
    published = counts.agg(
        F.sum(F.when(F.col("asset") == "clean", F.col("actual_rows"))).alias("clean_rows"),
        F.sum(F.when(F.col("asset") == "quarantined", F.col("actual_rows"))).alias(
            "quarantined_rows"
        ),
    )
    # Both sides are single rows; the constant key keeps this an equality join.
    one = F.lit(feed.name).alias("feed")
    both = from_raw.select(one, "*").join(published.select(one, "*"), "feed")
    total = F.col("clean_rows") + F.col("quarantined_rows") + F.col("suppressed_rows")
    return both.select(
        "feed", "raw_rows", "clean_rows", "quarantined_rows", "suppressed_rows",
        (F.col("raw_rows") == total).alias("balanced"),
    )


def unknown_references(df: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is set but not found in ``known``."""
    return df.where(F.col(column).isNotNull()).join(known.select(column), column, "left_anti")


def column_audit(
    df: DataFrame,
    *,
    distinct: Sequence[str] = (),
    nulls: Sequence[str] = (),
    prefixes: Mapping[str, str] | None = None,
    equals: Mapping[str, str] | None = None,
    negatives: Sequence[str] = (),
) -> DataFrame:
    """(audit, column_name, value_count) from one aggregate over the table."""
    checks = {("distinct", c): F.count_distinct(c) for c in distinct}
    checks |= {("null", c): F.count_if(F.isnull(c)) for c in nulls}
    checks |= {
        ("prefix", c): F.count_if(F.startswith(F.col(c), F.lit(p)))
        for c, p in (prefixes or {}).items()
    }
    checks |= {("equal", c): F.count_if(F.col(c) == v) for c, v in (equals or {}).items()}
    checks |= {("negative", c): F.count_if(F.col(c) < 0) for c in negatives}
    names = [f"{kind}:{column}" for kind, column in checks]
    row = df.agg(*(check.alias(name) for check, name in zip(checks.values(), names)))
    parts = F.split("check", ":")
    return row.unpivot([], [F.col(f"`{n}`") for n in names], "check", "value_count").select(
        parts[0].alias("audit"), parts[1].alias("column_name"), "value_count"
    )


def table_digest(df: DataFrame) -> DataFrame:
    """(row_count, digest) independent of row order and partitioning."""
    # Summed as decimals, which leave room for 10**18 rows of 64-bit hashes.
    term = F.xxhash64(*sorted(df.columns)).cast("decimal(20,0)")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(term), F.lit(0)).cast("decimal(38,0)").alias("digest"),
    )


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """(left_rows, right_rows, only_left, only_right) counting copies, in one shuffle.

    Groups equal rows and compares how often each side has them; both sides aggregate before the
    shuffle. Plain columns are grouped by a 128-bit hash, so wide rows are neither held by the aggregate
    nor sent: rows that agree in it are taken as equal. Nested columns are grouped as they are, as a hash passes
    over the NULLs inside.
    """
    columns = left.columns
    sides = left.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    # Hashed after the union, which gives both sides the same types.
    nested = [f.name for f in sides.schema if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType, T.VariantType))]
    plain = [name for name in columns if name not in nested]
    flags = [F.isnull(name) for name in plain]
    halves = [F.xxhash64(F.lit(salt), *plain, *flags).alias(f"_hash_{salt}") for salt in (0, 1)]
    hashed = sides.select(*halves, *nested, "_l", "_r")
    per_row = hashed.groupBy("_hash_0", "_hash_1", *nested).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    surplus = F.col("_l") - F.col("_r")
    return per_row.agg(
        F.coalesce(F.sum("_l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("_r"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(F.greatest(surplus, F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-surplus, F.lit(0))), F.lit(0)).alias("only_right"),
    )
