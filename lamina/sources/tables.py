"""Where tables live, how they are named in the catalog, and how they are written."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RAW, CLEAN, PUBLISHED = "bronze", "silver", "gold"


@dataclass(frozen=True)
class Namespace:
    """Catalog and schema names, from the session configuration or the defaults."""

    catalog: str = "spark_catalog"
    bronze_schema: str = "lamina_bronze"
    silver_schema: str = "lamina_silver"
    gold_schema: str = "lamina_gold"
    landing_path: str = "landing"

    @classmethod
    def from_conf(cls, spark: SparkSession) -> Namespace:
        given = {
            name: spark.conf.get(f"lamina.{name}", default)
            for name, default in vars(cls()).items()
        }
        return cls(**given)

    def table(self, layer: str, name: str) -> str:
        schema = {
            RAW: self.bronze_schema, CLEAN: self.silver_schema, PUBLISHED: self.gold_schema,
        }[layer]
        return f"{self.catalog}.{schema}.{name}"


@dataclass(frozen=True)
class TableInfo:
    """Comment and properties a table is published with."""

    name: str
    layer: str
    comment: str
    extra: dict[str, str] = field(default_factory=dict)

    @property
    def properties(self) -> dict[str, str]:
        # Property names that consumers look up.
        return {"quality": self.layer, "demo.synthetic": "true", **self.extra}


_QUARANTINE = {"quality.status": "quarantine"}
_ANONYMOUS = {"contains_direct_identifiers": "false"}

TABLES = {
    info.name: info
    for info in (
        TableInfo("client_profiles_raw", RAW, "Client profile changes as they landed."),
        TableInfo("campaigns_raw", RAW, "Campaign plans as they landed."),
        TableInfo("engagement_events_raw", RAW, "Engagement events as they landed."),
        TableInfo("client_profile_changes", CLEAN, "Accepted profile changes, one per identity."),
        TableInfo("campaigns_clean", CLEAN, "Accepted campaigns, first arrival per id."),
        TableInfo("engagement_events_clean", CLEAN, "Accepted events, first arrival per id."),
        TableInfo("client_profiles_quarantine", CLEAN, "Rejected profile changes.", _QUARANTINE),
        TableInfo("campaigns_quarantine", CLEAN, "Rejected campaigns.", _QUARANTINE),
        TableInfo("engagement_events_quarantine", CLEAN, "Rejected events.", _QUARANTINE),
        TableInfo("client_profile_history", CLEAN, "Type 2 versions of client profiles."),
        TableInfo("dim_client", PUBLISHED, "Client profile versions without ids.", _ANONYMOUS),
        TableInfo("dim_campaign", PUBLISHED, "Campaign attributes.", _ANONYMOUS),
        TableInfo(
            "fact_engagement_daily", PUBLISHED,
            "Engagement per day, client version, campaign and channel.", _ANONYMOUS,
        ),
    )
}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder is there. Asks the file system, which lists no files for the answer."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def batches(spark: SparkSession, path: str, prefix: str = "batch=") -> list[int]:
    """Numbers of the ``batch=`` folders of a table written batch by batch, rising.

    Lists one level of folders; asking Spark for the values would open every file.
    """
    if not exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    entries = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [entry.getPath().getName() for entry in entries]
    return sorted(int(name.removeprefix(prefix)) for name in names if name.startswith(prefix))


def last_batch(spark: SparkSession, path: str) -> int:
    """Highest ``batch=`` folder of a table written batch by batch, -1 without any."""
    return max(batches(spark, path), default=-1)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or no rows when nothing has been written there yet."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Rebuild a derived table from its current inputs.

    For partitioned tables the rebalance hint lets adaptive execution size the files: small
    partition values share a task, a value with too many rows is split over several. Others are
    written as they come, without a shuffle of their own.
    """
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(
            *partition_by
        ).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partition values present in ``df``."""
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def read_table(spark: SparkSession, namespace: Namespace, name: str) -> DataFrame:
    """Snapshot read of a registered table by its catalog name."""
    return spark.read.table(namespace.table(TABLES[name].layer, name))


def save_as_table(
    df: DataFrame, namespace: Namespace, name: str, partition_by: Sequence[str] = ()
) -> None:
    """Rebuild a catalog table with its comment and properties."""
    info = TABLES[name]
    target = namespace.table(info.layer, name)
    spark = df.sparkSession
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.mode("overwrite").format("parquet").saveAsTable(
        target, partitionBy=list(partition_by) or None
    )
    pairs = ", ".join(f"'{key}' = '{value}'" for key, value in info.properties.items())
    spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ({pairs})")
    spark.sql(f"COMMENT ON TABLE {target} IS '{info.comment}'")
