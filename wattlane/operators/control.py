"""Rows of the control tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from wattlane.functions.status import freshness_status
from wattlane.schemas import FRESHNESS_LOG, PIPELINE_STATE, RUN_METRICS
from wattlane.window import BatchWindow

PIPELINE_NAME = "eia_grid_batch"


def freshness_signals(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """Newest ingestion and newest observation side by side in one row."""
    ingested = raw.agg(F.max("_ingestion_timestamp").alias("pipeline_freshness_timestamp"))
    observed = staged.agg(F.max("observation_timestamp").alias("data_freshness_timestamp"))
    return ingested.unionByName(observed, allowMissingColumns=True).agg(
        F.max("pipeline_freshness_timestamp").alias("pipeline_freshness_timestamp"),
        F.max("data_freshness_timestamp").alias("data_freshness_timestamp"),
    )


def freshness_row(signals: DataFrame, run_id: str, checked_at: datetime) -> DataFrame:
    checked = F.lit(checked_at)
    pipeline, data = F.col("pipeline_freshness_timestamp"), F.col("data_freshness_timestamp")
    return signals.select(
        F.lit(run_id).alias("run_id"),
        pipeline,
        data,
        freshness_status(pipeline, checked).alias("pipeline_freshness_status"),
        freshness_status(data, checked).alias("data_freshness_status"),
        checked.alias("checked_at"),
    ).select(*FRESHNESS_LOG.fieldNames())


def unknown_freshness_row(spark: SparkSession, run_id: str, checked_at: datetime) -> DataFrame:
    """What the log holds when the signals could not be read."""
    return spark.createDataFrame(
        [(run_id, None, None, "unknown", "unknown", checked_at)], FRESHNESS_LOG
    )


def check_totals(results: DataFrame) -> DataFrame:
    """Models and checks that passed or failed, and bytes, from one row per result."""
    node = F.col("unique_id")
    status = F.col("status")
    return results.agg(
        F.count_if(node.startswith("model.") & (status == "success")).alias("models_passed"),
        F.count_if(node.startswith("test.") & status.isin("pass", "success")).alias(
            "tests_passed"
        ),
        F.count_if(node.startswith("test.") & status.isin("fail", "error")).alias("tests_failed"),
        F.coalesce(F.sum("bytes_processed"), F.lit(0)).cast("long").alias("bytes_processed"),
    )


def run_result_rows(documents: DataFrame) -> DataFrame:
    """One row per entry of a nested result document."""
    return documents.select(F.explode("results").alias("result")).select(
        "result.unique_id",
        "result.status",
        F.col("result.adapter_response.bytes_processed").alias("bytes_processed"),
    )


def run_metrics_row(
    totals: DataFrame,
    *,
    run_id: str,
    job_id: str,
    execution_date: datetime,
    window: BatchWindow,
    rows_loaded: int,
    started_at: datetime,
    status: str,
    created_at: datetime,
) -> DataFrame:
    duration = max((created_at - started_at).total_seconds(), 0.0)
    return totals.select(
        F.lit(run_id).alias("run_id"),
        F.lit(job_id).alias("dag_id"),
        F.lit(execution_date).alias("execution_date"),
        F.lit(window.start).alias("window_start"),
        F.lit(window.end).alias("window_end"),
        F.lit(rows_loaded).cast("long").alias("rows_loaded"),
        F.col("models_passed").cast("long").alias("dbt_models_passed"),
        F.col("tests_passed").cast("long").alias("dbt_tests_passed"),
        F.col("tests_failed").cast("long").alias("dbt_tests_failed"),
        F.col("bytes_processed").cast("long").alias("bytes_processed"),
        F.lit(duration).alias("duration_seconds"),
        F.lit(status).alias("status"),
        F.lit(created_at).alias("created_at"),
    ).select(*RUN_METRICS.fieldNames())


def run_metrics_rows(
    spark: SparkSession,
    runs: Mapping[str, BatchWindow],
    rows_by_batch: Mapping[str, int],
    totals: Row,
    started_at: datetime,
    status: str,
    created_at: datetime,
) -> DataFrame:
    """A row for each window of a run; all share its totals, duration and status."""
    duration = max((created_at - started_at).total_seconds(), 0.0)
    rows = [
        (
            run_id, PIPELINE_NAME, window.end, window.start, window.end,
            rows_by_batch.get(window.batch_id, 0), totals["models_passed"],
            totals["tests_passed"], totals["tests_failed"], totals["bytes_processed"],
            duration, status, created_at,
        )
        for run_id, window in runs.items()
    ]
    return spark.createDataFrame(rows, RUN_METRICS)


def state_row(
    spark: SparkSession, window: BatchWindow, run_id: str, updated_at: datetime
) -> DataFrame:
    return spark.createDataFrame(
        [(PIPELINE_NAME, window.start, window.end, run_id, updated_at)], PIPELINE_STATE
    )
