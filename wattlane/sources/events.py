"""Grid observations derived from the generic ``events`` and ``nation`` tables."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.schemas import RAW
from wattlane.sources.pages import FUEL_TYPE_ROWS, REGION_ROWS

REGIONS = 25

# Event type to metric type and label, and the fuels of a purchase.
TYPES = {
    "error": ("D", "Demand"),
    "click": ("DF", "Day-ahead demand forecast"),
    "view": ("NG", "Net generation"),
    "signup": ("TI", "Total interchange"),
    "purchase": ("generation", "Generation"),
}
FUELS = {"NG": "Natural gas", "SUN": "Solar", "WND": "Wind", "NUC": "Nuclear"}
UNITS = " MegawattHours "


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(item) for item in chain(*pairs.items())])[key]


def grid_rows(events: DataFrame, nation: DataFrame) -> DataFrame:
    """Raw-schema rows, one per hour, region, metric and fuel, in daily batches.

    Events are summed before the region names join on, so the join sees one row per
    grain and the 25 nations, however many events a region holds.
    """
    moment = F.col("ts").cast("timestamp")
    fuel = F.when(
        F.col("event_type") == "purchase",
        F.element_at(
            F.array(*[F.lit(code) for code in FUELS]), (F.col("event_id") % 4 + 1).cast("int")
        ),
    )
    hourly = (
        events.select(
            F.date_trunc("hour", moment).alias("hour"),
            (F.col("user_id") % REGIONS).cast("int").alias("n_nationkey"),
            "event_type",
            fuel.alias("fueltype"),
            "value",
        )
        .groupBy("hour", "n_nationkey", "event_type", "fueltype")
        .agg(F.round(F.sum("value"), 2).alias("value"))
    )
    day = F.date_trunc("day", F.col("hour"))
    stamp = "yyyyMMdd'T'HHmmss"
    kind = F.when(F.col("fueltype").isNull(), REGION_ROWS).otherwise(FUEL_TYPE_ROWS)
    return hourly.join(nation.select("n_nationkey", "n_name"), "n_nationkey").select(
        F.concat(F.lit("R"), F.col("n_nationkey")).alias("respondent"),
        F.col("n_name").alias("respondent_name"),
        _lookup({k: v[0] for k, v in TYPES.items()}, F.col("event_type")).alias("type"),
        _lookup({k: v[1] for k, v in TYPES.items()}, F.col("event_type")).alias("type_name"),
        "value",
        F.lit(UNITS).alias("value_units"),
        F.date_format("hour", "yyyy-MM-dd'T'HH").alias("period"),
        "fueltype",
        _lookup(FUELS, F.col("fueltype")).alias("fueltype_name"),
        F.to_date("hour").alias("batch_date"),
        F.concat_ws(
            "_",
            F.date_format(day, stamp),
            F.date_format(day + F.expr("interval 1 day"), stamp),
        ).alias("_batch_id"),
        F.concat(F.lit("events/"), kind).alias("_source_url"),
        (F.col("hour") + F.expr("interval 65 minutes")).alias("_ingestion_timestamp"),
    ).select(*RAW.fieldNames())


def as_pages(raw: DataFrame) -> DataFrame:
    """The rows folded back into pages of one hour, region and family each."""
    is_fuel = F.col("fueltype").isNotNull()
    row = F.struct(
        "period",
        "respondent",
        F.col("respondent_name").alias("respondent-name"),
        F.when(~is_fuel, F.col("type")).alias("type"),
        "fueltype",
        F.when(is_fuel, F.col("fueltype_name")).otherwise(F.col("type_name")).alias("type-name"),
        F.col("value").cast("string").alias("value"),
        F.col("value_units").alias("value-units"),
    )
    kind = F.when(is_fuel, FUEL_TYPE_ROWS).otherwise(REGION_ROWS)
    return (
        raw.groupBy("batch_date", "period", "respondent", kind.alias("row_kind"))
        .agg(F.collect_list(row).alias("data"))
        .select(
            "row_kind",
            F.struct(F.size("data").cast("string").alias("total"), "data").alias("response"),
        )
    )
