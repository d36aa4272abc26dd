"""Exact percentiles of a duration column per group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The reported percentiles.
PERCENTILES = {"p50_ms": 0.50, "p95_ms": 0.95, "p99_ms": 0.99}

BANDS_PER_OCTAVE = 64
PARTS_PER_BAND = 4096


def _band(value: Column) -> Column:
    """Integer that never falls as the value rises, as fine for small values as for large."""
    size = F.floor(F.log2(F.abs(value)) * BANDS_PER_OCTAVE) + 1100 * BANDS_PER_OCTAVE
    return F.when(value == 0, 0).otherwise(F.signum(value) * size).cast("int")


def _part(value: Column, low: Column, high: Column) -> Column:
    """Equal parts of a band, numbered upwards between the values that it really holds."""
    share = F.when(high > low, (value - low) / (high - low)).otherwise(0.0)
    return F.floor(share * PARTS_PER_BAND).cast("int")


def _join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which NULL keys match each other."""
    renamed = right.withColumnsRenamed({key: f"right_{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"right_{key}")) for key in keys]
    return left.join(renamed, same).drop(*[f"right_{key}" for key in keys])


def _counted(requests: DataFrame, by: list[str], seconds: str) -> DataFrame:
    return (
        requests.where(F.col(seconds).isNotNull())
        .groupBy(*by, F.col(seconds).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("band", _band(F.col("value")))
    )


def _bands(counted: DataFrame, by: list[str]) -> DataFrame:
    return counted.groupBy(*by, "band").agg(
        F.sum("n").alias("in_band"),
        F.sum(F.col("value") * F.col("n")).alias("total"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )


def _wanted() -> dict[str, Column]:
    position = {name: (F.col("all_rows") - 1) * p for name, p in PERCENTILES.items()}
    return {f"{name}_{side.__name__}": side(at) for name, at in position.items()
            for side in (F.floor, F.ceil)}


def _holds_wanted(before: Column, until: Column) -> Column:
    return reduce(lambda a, b: a | b, [(at >= before) & (at < until) for at in _wanted().values()])


def narrowed(counted: DataFrame, bands: DataFrame, by: list[str]) -> DataFrame:
    """Values of the parts of bands that hold a wanted position, with the rows before each.

    Bands are found among all bands of a group, then parts among all of a band; what is
    left to order is a few in a thousand of a band, itself a narrow range of values.
    """
    in_order = Window.partitionBy(*by).orderBy("band")
    placed = bands.withColumns(
        {
            "until": F.sum("in_band").over(in_order),
            "all_rows": F.sum("in_band").over(Window.partitionBy(*by)),
        }
    ).withColumn("before", F.col("until") - F.col("in_band"))
    picked = placed.where(_holds_wanted(F.col("before"), F.col("until"))).select(
        *by, "band", "before", "all_rows", "low", "high"
    )
    inside = _join(counted, picked, [*by, "band"]).withColumn(
        "part", _part(F.col("value"), F.col("low"), F.col("high"))
    )
    parts = inside.groupBy(*by, "band", "part", "before", "all_rows").agg(F.sum("n").alias("in_part"))
    in_band = Window.partitionBy(*by, "band").orderBy("part")
    until = F.col("before") + F.sum("in_part").over(in_band)
    chosen = (
        parts.withColumn("until", until)
        .withColumn("first", F.col("until") - F.col("in_part"))
        .where(_holds_wanted(F.col("first"), F.col("until")))
        .select(*by, "band", "part", "first")
    )
    return _join(inside.drop("before", "low", "high"), chosen, [*by, "band", "part"])


def latency_summary(requests: DataFrame, by: list[str], seconds: str) -> DataFrame:
    """Count, mean, linearly interpolated percentiles and extremes in milliseconds.

    The built-in percentile keeps every distinct value of a group in one task. Here equal
    values are counted first, the counts are added up per band of values and per part of
    the bands in question, and only the parts that hold a wanted position are put in order,
    each in a task of its own.
    """
    counted = _counted(requests, by, seconds)
    bands = _bands(counted, by)
    wanted = _wanted()
    inside = Window.partitionBy(*by, "band", "part").orderBy("value")
    ordered = (
        narrowed(counted, bands, by)
        .withColumn("end", F.col("first") + F.sum("n").over(inside))
        .withColumn("start", F.col("end") - F.col("n"))
    )
    at_position = ordered.groupBy(*by).agg(
        *[
            F.max(F.when((at >= F.col("start")) & (at < F.col("end")), F.col("value"))).alias(name)
            for name, at in wanted.items()
        ]
    )
    stats = bands.groupBy(*by).agg(
        F.sum("in_band").alias("count"),
        (F.sum("total") / F.sum("in_band") * 1000).alias("avg_ms"),
        (F.min("low") * 1000).alias("fastest_ms"),
        (F.max("high") * 1000).alias("slowest_ms"),
    )

    def interpolated(name: str, p: float) -> Column:
        at = (F.col("count") - 1) * p
        low, high = F.col(f"{name}_floor"), F.col(f"{name}_ceil")
        return (low + (high - low) * (at - F.floor(at))) * 1000

    return _join(stats, at_position, by).select(
        *by,
        F.col("count").cast("double").alias("count"),
        "avg_ms",
        *[interpolated(name, p).alias(name) for name, p in PERCENTILES.items()],
        "fastest_ms",
        "slowest_ms",
    )
