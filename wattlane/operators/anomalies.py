"""Daily values against the mean of the seven calendar days before."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlane.functions.periods import in_dates, with_history
from wattlane.functions.scoring import BASELINE_DAYS, anomaly_flag, pct_deviation
from wattlane.schemas import ANOMALY_RESULTS


def daily_metrics(load_daily: DataFrame, generation_mix: DataFrame) -> DataFrame:
    """Demand rows as they are, generation summed over its sources."""
    demand = load_daily.select(
        "observation_date",
        "region",
        F.lit("demand").alias("metric_name"),
        F.col("total_load").alias("current_value"),
    )
    generation = (
        generation_mix.groupBy("observation_date", "region")
        .agg(F.sum("daily_total_generation").alias("current_value"))
        .select(
            "observation_date", "region", F.lit("generation").alias("metric_name"), "current_value"
        )
    )
    return demand.unionByName(generation)


def with_baseline(metrics: DataFrame) -> DataFrame:
    """Mean of the days present in ``[d-7, d-1]``: one shuffle instead of a range self-join.

    A window holds one region's days, so its size follows the calendar.
    """
    week = (
        Window.partitionBy("region", "metric_name")
        .orderBy(F.unix_date("observation_date"))
        .rangeBetween(-BASELINE_DAYS, -1)
    )
    return metrics.withColumn("rolling_7d_avg", F.avg("current_value").over(week))


def score(metrics: DataFrame, dates: Iterable[date] | None = None) -> DataFrame:
    """Deviation and flag per day, region and metric, for ``dates`` or all days.

    Only the dates and the week before each are read.
    """
    day = F.col("observation_date")
    if dates is not None:
        dates = list(dates)
        metrics = metrics.where(in_dates(day, with_history(dates, BASELINE_DAYS)))
    scored = with_baseline(metrics)
    if dates is not None:
        scored = scored.where(in_dates(day, dates))
    deviation = pct_deviation(F.col("current_value"), F.col("rolling_7d_avg"))
    return scored.withColumn("pct_deviation", deviation).withColumn(
        "anomaly_flag", anomaly_flag(F.col("pct_deviation"))
    )


def anomaly_rows(scored: DataFrame, run_id: str, checked_at: datetime) -> DataFrame:
    return scored.withColumns(
        {"run_id": F.lit(run_id), "checked_at": F.lit(checked_at)}
    ).select(*ANOMALY_RESULTS.fieldNames())


def latest_scores(results: DataFrame) -> DataFrame:
    """One row per day, region and metric: the newest check among reruns."""
    keys = ["observation_date", "region", "metric_name"]
    newest = results.groupBy(*keys).agg(F.max("checked_at").alias("checked_at"))
    return results.join(newest, [*keys, "checked_at"], "left_semi")
