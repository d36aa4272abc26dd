"""Landed windows picked up as they arrive, in place of polling for new ones."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wattlane.lake import Lake
from wattlane.plans import jobs
from wattlane.schemas import RAW
from wattlane.sources.landing import read_landed
from wattlane.window import BatchWindow


def load_arriving(
    lake: Lake,
    landing: str,
    checkpoint: str,
    *,
    max_files: int = 1000,
    run_prefix: str = "stream",
    checked_at: datetime | None = None,
) -> StreamingQuery:
    """Load every window with new landed files, then stop; the checkpoint resumes it.

    Windows of a micro-batch of ``max_files`` run together, with checks, scores and control
    rows. A micro-batch may hold part of a window, so it only names the windows: each is loaded
    whole from its landing folder, which also makes a repeated micro-batch harmless.
    """

    def load(arrived: DataFrame, _: int) -> None:
        ids = [row["_batch_id"] for row in arrived.select("_batch_id").distinct().collect()]
        if ids:
            windows = sorted(map(BatchWindow.from_batch_id, ids), key=lambda w: w.start)
            rows = read_landed(lake.spark, landing, windows)
            jobs.bulk_backfill(lake, rows, windows, run_prefix, checked_at=checked_at)

    # The landing keys are read off the folder names and are not part of the rows.
    reader = lake.spark.readStream.schema(RAW).option("mode", "FAILFAST")
    files = reader.option("maxFilesPerTrigger", max_files).json(landing)
    return (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
