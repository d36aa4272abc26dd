"""Lakes built from the given tables, once per session and scale."""

from __future__ import annotations

import atexit
from datetime import UTC, date, datetime, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.lake import Lake
from wattlane.operators import marts
from wattlane.operators.anomalies import daily_metrics, score
from wattlane.operators.staging import canonicalise
from wattlane.plans import jobs
from wattlane.session import prepare, shared_folder
from wattlane.sources.events import grid_rows
from wattlane.window import daily_window

_LOADED: dict[tuple[str, str], tuple[Lake, jobs.Loaded]] = {}
_LAKES: dict[tuple[str, str], Lake] = {}
_SCRATCH: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_rows(table(spark, sf_dir, "events"), table(spark, sf_dir, "nation"))


def staged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonicalise(raw_rows(spark, sf_dir))


def views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The derived tables as plans over the given ones; nothing is written."""
    staged = staged_rows(spark, sf_dir)
    daily, mix = marts.load_daily(staged), marts.generation_mix(staged)
    return {
        "eia_grid_batch": raw_rows(spark, sf_dir),
        "stg_grid_metrics": staged,
        "fct_grid_metrics": staged,
        "dim_region": marts.dim_region(staged),
        "dim_energy_source": marts.dim_energy_source(staged),
        "agg_load_hourly": marts.load_hourly(staged),
        "agg_load_daily": daily,
        "agg_generation_mix": mix,
        "agg_top_regions": marts.top_regions(daily),
        "scores": score(daily_metrics(daily, mix)),
    }


def fresh_lake(spark: SparkSession, name: str = "lake") -> Lake:
    """A lake of its own folder, which goes when the process that asked for it ends."""
    root = f"{shared_folder(spark)}/{name}-{uuid4().hex}"
    if not _SCRATCH:
        atexit.register(_clear_scratch)
    _SCRATCH.append((spark, root))
    return Lake(spark, root)


def _clear_scratch() -> None:
    for spark, root in _SCRATCH:
        try:
            folder = spark._jvm.org.apache.hadoop.fs.Path(root)
            files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
            files.delete(folder, True)
        except Exception:  # the session is gone already
            return


def batch_days(raw: DataFrame) -> list[date]:
    """Batch days of the rows: one per calendar day."""
    found = raw.select(F.col("batch_date")).distinct().orderBy("batch_date").collect()
    return [row["batch_date"] for row in found]


def check_times(days: list[date]) -> list[datetime]:
    """Two checks after the last day: both signals fresh, then the data stale."""
    midnight = datetime.combine(max(days), datetime.min.time(), UTC) + timedelta(days=1)
    return [midnight + timedelta(hours=3), midnight + timedelta(hours=5, minutes=30)]


def _loaded(spark: SparkSession, sf_dir: str) -> tuple[Lake, jobs.Loaded]:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOADED:
        lake = fresh_lake(spark)
        raw = raw_rows(spark, sf_dir)
        windows = [daily_window(day) for day in batch_days(raw)]
        _LOADED[key] = lake, jobs.load_and_rebuild(lake, raw, windows)
    return _LOADED[key]


def loaded_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The raw table and all that is built from it, written from the whole events table.

    The lake is that of ``built_lake``, whose checks, scores and control rows read these
    tables and change none of them.
    """
    return _loaded(spark, sf_dir)[0]


def built_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Every table written from the whole events table, with two scored and logged runs."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        lake, loaded = _loaded(spark, sf_dir)
        window = daily_window(loaded.batch_dates[-1])
        checks = jobs.run_checks(lake).collect()
        for run, checked_at in enumerate(check_times(loaded.batch_dates), start=1):
            run_id = f"run{run}"
            jobs.score_anomalies(lake, loaded.affected_dates, run_id, checked_at)
            jobs.log_freshness(lake, run_id, checked_at)
            jobs.advance_state(lake, window, run_id, checked_at)
            jobs.record_run(
                lake,
                run_id=run_id,
                window=window,
                rows_loaded=loaded.rows,
                results=jobs.result_rows(lake, checks, built=True),
                status="success",
                started_at=checked_at - timedelta(minutes=10),
                created_at=checked_at,
            )
        _LAKES[key] = lake
    return _LAKES[key]
