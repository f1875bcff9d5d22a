"""Session settings every job relies on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


#: Sizes are estimated from compressed files, rows in memory take many times that. All broadcasts pass through the driver.
BROADCAST, BROADCAST_MOST = "spark.sql.autoBroadcastJoinThreshold", "2m"


def pin_session(spark: SparkSession) -> SparkSession:
    """Version keys and activity dates depend on the time zone, so it is always UTC.

    Joins broadcast sides of up to BROADCAST_MOST, unless the session has a limit of its own.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if BROADCAST not in spark.conf.getAll:
        spark.conf.set(BROADCAST, BROADCAST_MOST)
    return spark


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach, for written intermediate tables.

    The cluster names the parent in ``spark.checkpoint.dir``. Only a local master may do without: then
    a temporary folder of this machine stands in. Elsewhere each executor would write its own disk,
    so a missing setting is an error.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if not parent:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        parent = tempfile.mkdtemp(prefix="lamina-")
    return f"{parent.rstrip('/')}/{label}-{uuid.uuid4().hex}"
