"""Newline-delimited JSON landing zone, one folder per window."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.lake import enforce, missing_required
from wattlane.schemas import RAW, TABLES
from wattlane.window import BatchWindow

LANDING_KEYS = ("year", "month", "day", "window")

# Six digits, as timestamps have: fewer would cut them.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def land(rows: DataFrame, root: str) -> None:
    """Write raw rows under ``year=/month=/day=/window=``, replacing each window it holds.

    The window start is read from the batch id, so one call lands any number of windows.
    """
    start = F.to_timestamp(
        F.substring_index(F.col("_batch_id"), "_", 1), "yyyyMMdd'T'HHmmss"
    )
    keyed = rows.select(
        *RAW.fieldNames(),
        F.date_format(start, "yyyy").alias("year"),
        F.date_format(start, "MM").alias("month"),
        F.date_format(start, "dd").alias("day"),
        F.concat(F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("window"),
    )
    (
        keyed.hint("rebalance", *[F.col(key) for key in LANDING_KEYS])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", False)
        .option("timestampFormat", TIME_FORMAT)
        .partitionBy(*LANDING_KEYS)
        .json(root)
    )


def read_landed(
    spark: SparkSession, path: str, windows: Iterable[BatchWindow] | None = None
) -> DataFrame:
    """Landed rows under the raw schema, of all windows or of the folders of some.

    Malformed text or a missing required value fails the job.
    """
    reader = spark.read.schema(RAW).option("mode", "FAILFAST")
    reader = reader.option("timestampFormat", TIME_FORMAT)
    if windows is None:
        rows = reader.json(path)
    else:
        # Named folders: nothing else of the landing zone is listed.
        folders = sorted({window_folder(path, window) for window in windows})
        rows = reader.option("basePath", path).json(folders)
    return enforce_required(rows.select(*RAW.fieldNames()))


def window_folder(root: str, window: BatchWindow) -> str:
    start = window.start
    return (
        f"{root.rstrip('/')}/year={start:%Y}/month={start:%m}/day={start:%d}/"
        f"window={start:%Y-%m-%dT%H%%3A%M%%3A%S}+00%3A00"
    )


def enforce_required(rows: DataFrame) -> DataFrame:
    missing = missing_required(TABLES["eia_grid_batch"])
    return enforce(
        rows, F.when(missing != "", F.concat(F.lit("missing required columns: "), missing))
    )
