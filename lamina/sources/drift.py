"""Fitting landed files to the declared columns without losing what does not fit."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"
MERGE_CONFLICT = "[CANNOT_MERGE_SCHEMAS]"
PARTS_AT_ONCE = 16


def conform(df: DataFrame, declared: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Declared columns plus ``_rescued_data``; ``keep`` names further columns to carry along.

    Names match regardless of case. Absent columns become NULL. Unknown columns, and values that do
    not convert to the declared type without loss, go into ``_rescued_data`` as JSON; it is NULL when nothing
    was rescued.
    """
    present = {name.lower(): name for name in df.columns if name not in keep}
    fitted, rescued = [], []
    for field in declared:
        found = present.pop(field.name.lower(), None)
        if found is None:
            fitted.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        source = F.col(f"`{found}`")
        if df.schema[found].dataType == field.dataType:
            fitted.append(source.alias(field.name))
            continue
        converted = source.try_cast(field.dataType)
        fitted.append(converted.alias(field.name))
        lost = converted.isNull()
        if not isinstance(df.schema[found].dataType, T.StringType):
            # A number that does not survive the way back has lost something; text may be written variously.
            lost = lost | ~converted.try_cast(df.schema[found].dataType).eqNullSafe(source)
        rescued.append(F.when(lost, source).alias(found))
    rescued += [F.col(f"`{name}`").alias(name) for name in present.values()]
    if rescued:
        # to_json leaves out NULL fields, so rows with nothing to rescue come out as {}.
        text = F.nullif(F.to_json(F.struct(*rescued)), F.lit("{}"))
    else:
        text = F.lit(None).cast("string")
    return df.select(*fitted, text.alias(RESCUED), *keep)


def frames_by_schema(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """Read the files as few frames as their schemas allow, normally one.

    Files that cannot be read under one merged schema are halved until each part can; parts with
    the same schema are then read together again. Spark tasks read the footers, and the parts of
    one round are tried side by side, so even a batch of all different files takes few rounds.
    """
    by_schema: dict[str, tuple[T.StructType, list[str]]] = {}
    parts = [list(paths)]
    with ThreadPoolExecutor(PARTS_AT_ONCE) as pool:
        while parts:
            schemas = list(pool.map(lambda part: _merged_schema(spark, part), parts))
            halves = []
            for schema, part in zip(schemas, parts):
                if schema is None:
                    middle = len(part) // 2
                    halves += [part[:middle], part[middle:]]
                else:
                    by_schema.setdefault(schema.json(), (schema, []))[1].extend(part)
            parts = halves
    return [spark.read.schema(schema).parquet(*part) for schema, part in by_schema.values()]


def _merged_schema(spark: SparkSession, paths: list[str]) -> T.StructType | None:
    """The common schema, or None if the files contradict each other."""
    try:
        return spark.read.option("mergeSchema", True).parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as problem:
        if len(paths) == 1 or MERGE_CONFLICT not in str(problem):
            raise
        return None


def read_with_rescue(
    spark: SparkSession, paths: Sequence[str], declared: T.StructType, lineage: dict
) -> DataFrame:
    """All rows of the files, fitted to ``declared``, with the lineage columns added."""
    parts = [
        conform(df.withColumns(lineage), declared, keep=tuple(lineage))
        for df in frames_by_schema(spark, paths)
    ]
    return reduce(DataFrame.unionByName, parts)
