"""Clean profile changes to Type 2 history, rebuilding only the clients that changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lamina.feeds import CLIENT_PROFILES
from lamina.functions.skew import MIN_ROWS, heavy_or_none
from lamina.operators.history import PROFILE_KEYS, profile_history
from lamina.sources.lake import Lake
from lamina.sources.landing import NO_MAX_AGE
from lamina.streaming.clean import profile_bucket


def start_history(
    spark: SparkSession, lake: Lake, heavy_min_rows: int = MIN_ROWS
) -> StreamingQuery:
    """Rebuild the clients that received changes since the last run, and append their versions.

    History is always derived from the stored changes, so late and repeated changes need no merge:
    the result depends on the set of changes only. What is written follows the clients touched, not
    the history: see ``sources.log_table``.
    """
    columns = CLIENT_PROFILES.typed_schema.names

    def rebuild(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        log = lake.arrivals_log(CLIENT_PROFILES)
        # A short list: the batches of arrivals since the last run.
        numbers = [row.batch for row in batch.select("batch").distinct().collect()]
        if not numbers:
            return
        # A copy that was taken back may have been the accepted one.
        replaced = log.rebuilt(session, min(numbers) - 1, max(numbers)).select(*PROFILE_KEYS)
        clients = batch.where("accepted").select(*PROFILE_KEYS).unionAll(replaced).dropna().distinct()
        touched = lake.staging_path("touched_clients")
        clients.write.mode("overwrite").parquet(touched)
        clients = session.read.schema(clients.schema).parquet(touched)
        changes = log.live(session, max(numbers)).where("accepted")
        if batch_id > 0:
            # At most lake.buckets small numbers; literals let the scan skip the other partitions.
            found = clients.select(profile_bucket(lake.buckets).alias("bucket")).distinct().collect()
            changes = changes.where(F.col("bucket").isin([row.bucket for row in found]))
            changes = changes.join(clients, list(PROFILE_KEYS), "left_semi")
        changes = changes.select(columns)
        versions = profile_history(
            changes, heavy_or_none(changes, PROFILE_KEYS, min_rows=heavy_min_rows)
        )
        lake.history_log.append(versions, clients, batch_id)

    return (
        spark.readStream.option("maxFileAge", NO_MAX_AGE).schema(lake.arrivals_schema(CLIENT_PROFILES))
        .parquet(lake.arrivals_path(CLIENT_PROFILES))
        .select(*PROFILE_KEYS, "accepted", "batch")
        .writeStream.foreachBatch(rebuild)
        .option("checkpointLocation", lake.checkpoint("client_profile_history"))
        .trigger(availableNow=True)
        .start()
    )
