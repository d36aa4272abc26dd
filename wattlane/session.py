"""Session settings every job and query relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


#: A shuffle below this is one task's, so that days are written by as many tasks as there are cores.
LEAST_TASK = "16k"

LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
COALESCED = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin UTC: period parsing, date extraction and timestamp text all depend on it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def prepare_folders(spark: SparkSession) -> SparkSession:
    """Settings for tables of many small day folders, unless the session has its own.

    Spark lists each folder in a task of its own, and has one task write all days of a small
    table, a file at a time. Both cost by the folder, whatever its bytes.
    """
    cores = spark.sparkContext.defaultParallelism
    for name, value in {LISTING: str(4 * cores), COALESCED: LEAST_TASK}.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and work tables that every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may fall
    back to a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="wattlane-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder
