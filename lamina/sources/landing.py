"""Landed Parquet files of a feed: discovery as a stream of paths, reading as a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.feeds import Feed
from lamina.sources.drift import read_with_rescue

# What the binaryFile source delivers; a stream has to be told.
FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"
MAX_FILES_PER_BATCH = 10_000
# By default a file stream ignores files a week older than the newest one. Nothing landed is too old.
NO_MAX_AGE = "36500d"


def landed_paths(
    spark: SparkSession, folder: str, max_files: int = MAX_FILES_PER_BATCH
) -> DataFrame:
    """A stream with the path of every landed file, each once, files already there included.

    Neither name nor age keeps a file out; only hidden files (names with a leading dot or underscore)
    are no landed files.
    Only ``path`` is selected, so file contents are not read. ``max_files`` bounds how many paths
    one micro-batch brings to the driver.
    """
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("maxFileAge", NO_MAX_AGE)
        .option("maxFilesPerTrigger", max_files)
        .load(folder)
        .select("path")
    )


def read_landed(spark: SparkSession, paths: Sequence[str], feed: Feed) -> DataFrame:
    """The raw rows of these files: declared columns, rescued data and lineage."""
    lineage = {
        "_ingest_timestamp": F.current_timestamp(),
        "_source_file": F.col("_metadata.file_path"),
        "_source_modified": F.col("_metadata.file_modification_time"),
        "_source_system": F.lit(feed.source_label),
    }
    return read_with_rescue(spark, paths, feed.landed_schema, lineage)


def set_modified(spark: SparkSession, folder: str, millis: int) -> None:
    """Give all files below a folder another modification time, as copies that keep their times have.

    For stores that let times be set; object stores do not.
    """
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = top.getFileSystem(spark._jsc.hadoopConfiguration())
    files = system.listFiles(top, True)
    while files.hasNext():
        system.setTimes(files.next().getPath(), millis, -1)
