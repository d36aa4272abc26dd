"""Canonical long-format metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.functions.metrics import (
    energy_source,
    metric_name,
    surrogate_key,
    timestamp_text,
    unit_label,
)
from wattlane.functions.periods import parse_period
from wattlane.schemas import METRICS

GRAIN = ("region", "observation_timestamp", "metric_name", "energy_source")


def canonicalise(raw: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """One staged row per raw row, with the raw columns in ``keep`` beside it.

    Rows whose period cannot be parsed have a NULL date for the checks to report.
    """
    named = raw.select(
        F.col("respondent").alias("region"),
        F.col("respondent_name").alias("region_name"),
        parse_period(F.col("period")).alias("observation_timestamp"),
        metric_name(F.col("fueltype"), F.col("type"), F.col("type_name")).alias("metric_name"),
        F.col("value").cast("double").alias("metric_value"),
        energy_source(F.col("fueltype")).alias("energy_source"),
        unit_label(F.col("value_units")).alias("unit"),
        F.col("_ingestion_timestamp").cast("timestamp").alias("_ingestion_timestamp"),
        *keep,
    )
    key = surrogate_key(
        F.col("region"),
        timestamp_text(F.col("observation_timestamp")),
        F.col("metric_name"),
        F.col("energy_source"),
    )
    return named.withColumns(
        {
            "observation_date": F.to_date("observation_timestamp"),
            "metric_surrogate_key": key,
        }
    ).select(*METRICS.fieldNames(), *keep)


def observation_dates(raw: DataFrame) -> DataFrame:
    """Distinct days that raw rows touch; NULL periods touch none."""
    return (
        raw.select(F.to_date(parse_period(F.col("period"))).alias("observation_date"))
        .where(F.col("observation_date").isNotNull())
        .distinct()
    )


def newest_staged(raw: DataFrame) -> DataFrame:
    """Staged rows, of each grain those of its newest batch: one rule for every build."""
    return newest_batch(canonicalise(raw, keep=("_batch_id",)), "_batch_id")


def newest_batch(staged: DataFrame, *ties: str) -> DataFrame:
    """Per grain, the rows of the newest ingestion, of equal ones the greatest ``ties``.

    Duplicates inside that newest batch stay, for the uniqueness checks to find.
    Aggregating and joining back, unlike a window over the grain, never gathers a
    grain with very many copies in one task: the maximum combines on the map side and
    the adaptive join splits a skewed grain.
    """
    order = ["_ingestion_timestamp", *ties]
    # Ties are grouped by, so that the pass over all rows stays a hash aggregate.
    newest = staged.groupBy("metric_surrogate_key", *ties).agg(
        F.max("_ingestion_timestamp").alias("_ingestion_timestamp")
    )
    if ties:
        newest = newest.groupBy("metric_surrogate_key").agg(F.max(F.struct(*order)).alias("newest"))
        newest = newest.select("metric_surrogate_key", "newest.*")
    return staged.join(newest, ["metric_surrogate_key", *order], "left_semi").select(
        *METRICS.fieldNames()
    )
