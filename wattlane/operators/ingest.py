"""From tagged API rows to raw rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.lake import enforce
from wattlane.schemas import RAW
from wattlane.sources.pages import FUEL_TYPE_ROWS, REGION_ROWS
from wattlane.window import BatchWindow, utc_now

COMMON_FIELDS = ("respondent", "respondent-name", "type-name", "value", "value-units", "period")


class EmptyWindow(RuntimeError):
    """The extract of a window holds no rows."""


def require_rows(rows: DataFrame) -> DataFrame:
    """Reads at most one row to tell whether the window is empty."""
    if rows.isEmpty():
        raise EmptyWindow("extract contained no rows for the requested window")
    return rows


def stamp_batch(
    rows: DataFrame, window: BatchWindow, ingested_at: datetime | None = None
) -> DataFrame:
    return rows.withColumns(
        {
            "batch_date": F.lit(window.batch_date),
            "_batch_id": F.lit(window.batch_id),
            "_ingestion_timestamp": F.lit(ingested_at or utc_now()),
        }
    )


def numeric_value(text: Column) -> Column:
    """Double of a text, NULL where it is no number; type suffixes such as ``1d`` are text."""
    suffixed = text.rlike(r"[0-9.][dDfF]\s*$")
    return F.when(~suffixed, text.try_cast("double"))


def violation() -> Column:
    """What is wrong with a tagged row, NULL when nothing is."""
    kind = F.col("__row_kind")
    blank = {
        name: F.col(f"`{name}`").isNull() | (F.col(f"`{name}`") == "")
        for name in (*COMMON_FIELDS, "type", "fueltype")
    }
    missing = F.concat_ws(
        ", ",
        *[F.when(blank[name], F.lit(name)) for name in COMMON_FIELDS],
        F.when((kind == REGION_ROWS) & blank["type"], F.lit("type")),
        F.when((kind == FUEL_TYPE_ROWS) & blank["fueltype"], F.lit("fueltype")),
    )
    return (
        F.when(
            kind.isNull() | ~kind.isin(REGION_ROWS, FUEL_TYPE_ROWS),
            F.lit("row is missing the row kind marker"),
        )
        .when(missing != "", F.concat(F.lit("row is missing required fields: "), missing))
        .when(numeric_value(F.col("value")).isNull(), F.lit("row value must be numeric"))
    )


def _to_raw(rows: DataFrame) -> DataFrame:
    is_fuel = F.col("__row_kind") == FUEL_TYPE_ROWS
    return rows.select(
        "respondent",
        F.col("respondent-name").alias("respondent_name"),
        F.when(is_fuel, "generation").otherwise(F.col("type")).alias("type"),
        F.when(is_fuel, "Generation").otherwise(F.col("type-name")).alias("type_name"),
        numeric_value(F.col("value")).alias("value"),
        F.col("value-units").alias("value_units"),
        "period",
        F.when(is_fuel, F.col("fueltype")).alias("fueltype"),
        F.when(is_fuel, F.col("type-name")).alias("fueltype_name"),
        "batch_date",
        "_batch_id",
        F.coalesce("__source_url", F.lit("multiple")).alias("_source_url"),
        "_ingestion_timestamp",
    ).select(*RAW.fieldNames())


def normalise(rows: DataFrame) -> DataFrame:
    """Raw rows; the job fails on the first row that breaks the page contract."""
    return _to_raw(enforce(rows, violation()))


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw rows that hold the contract, and the others as they came with their violation."""
    judged = rows.withColumn("violation", violation())
    return (
        _to_raw(judged.where(F.col("violation").isNull())),
        judged.where(F.col("violation").isNotNull()),
    )
