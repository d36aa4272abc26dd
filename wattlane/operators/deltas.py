"""Daily aggregates kept up by signed changes, in place of a rebuild of their days.

States hold one row per region name, day, metric, source and unit: counts, an exact sum and
the extremes. Where rows of the fact are replaced, the rows that go count against a state and
those that come count for it, so only they and the states are read. Sums are decimals, so that
what goes leaves nothing behind, as sums of doubles would. An extreme that goes with no other
as far out coming is not known from the state: such groups, and changed ones with values that
no decimal of nine places holds, are read again from the fact, and no others.

Defined cases: nulls in a key are a value of their own; a null value counts as a row and is no
value; a group that loses all its rows goes; rows that go but never were there are an error
where a count falls below zero; of empty states and changes come empty states.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.operators.marts import DEMAND, KNOWN_GENERATION
from wattlane.schemas import AGG_GENERATION_MIX, AGG_LOAD_DAILY

KEYS = ("region", "region_name", "observation_date", "metric_name", "energy_source", "unit")
EXACT = "decimal(28,9)"


def _counted(fact: DataFrame, sign: int) -> DataFrame:
    """Rows that count for an aggregate, with their sign; a demand has no source."""
    generation = F.expr(KNOWN_GENERATION)
    value = F.col("metric_value")
    exact = value.try_cast(EXACT)
    odd = value.isNotNull() & ~F.coalesce(exact.cast("double") == value, F.lit(False))
    return fact.where(F.expr(DEMAND) | generation).select(
        *("region", "region_name", "observation_date", "metric_name"),
        F.when(generation, F.col("energy_source")).alias("energy_source"),
        "unit",
        value.alias("value"),
        odd.alias("odd"),
        F.when(~odd, exact if sign > 0 else -exact).cast(EXACT).alias("exact"),
        F.lit(sign).alias("sign"),
    )


def _counts() -> list[Column]:
    return [
        F.sum("sign").alias("n_rows"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("sign")).otherwise(0)).alias("n_values"),
        F.sum(F.when(F.col("odd"), F.col("sign")).otherwise(0)).alias("n_odd"),
        F.sum("exact").alias("total"),
    ]


def states(fact: DataFrame) -> DataFrame:
    """``KEYS``, ``n_rows``, ``n_values``, ``n_odd``, ``total`` (of values that are exact),
    ``odd_total`` (of the others), ``low`` and ``high``."""
    return (
        _counted(fact, 1)
        .groupBy(*KEYS)
        .agg(
            *_counts(),
            F.sum(F.when(F.col("odd"), F.col("value"))).alias("odd_total"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
    )


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Signed counts and sums of fact rows that go and come, and the extremes of either."""
    gone, come = F.col("sign") < 0, F.col("sign") > 0
    return (
        _counted(before, -1)
        .unionByName(_counted(after, 1))
        .groupBy(*KEYS)
        .agg(
            *_counts(),
            F.min(F.when(gone, F.col("value"))).alias("gone_low"),
            F.max(F.when(gone, F.col("value"))).alias("gone_high"),
            F.min(F.when(come, F.col("value"))).alias("come_low"),
            F.max(F.when(come, F.col("value"))).alias("come_high"),
        )
    )


def merged(held: DataFrame, changed: DataFrame) -> DataFrame:
    """States after the changes, with ``stale`` where they cannot be known from these alone.

    Either side has one row a group, so they are added up in one grouping; unchanged groups
    stay as they are.
    """
    both = held.withColumn("touched", F.lit(False)).unionByName(
        changed.withColumn("touched", F.lit(True)), allowMissingColumns=True
    )
    extremes = ("odd_total", "low", "high", "gone_low", "gone_high", "come_low", "come_high")
    sums = both.groupBy(*KEYS).agg(
        *(F.sum(name).alias(name) for name in ("n_rows", "n_values", "n_odd", "total")),
        *(F.max(name).alias(name) for name in extremes),
        F.max("touched").alias("touched"),
    )
    lost_low = (F.col("gone_low") <= F.col("low")) & ~F.coalesce(
        F.col("come_low") <= F.col("low"), F.lit(False)
    )
    lost_high = (F.col("gone_high") >= F.col("high")) & ~F.coalesce(
        F.col("come_high") >= F.col("high"), F.lit(False)
    )
    lost = F.coalesce(lost_low, F.lit(False)) | F.coalesce(lost_high, F.lit(False))
    has_values, touched = F.col("n_values") > 0, F.col("touched")
    foreign = F.least("n_rows", "n_values", "n_odd") < 0
    return sums.select(
        *KEYS,
        F.when(foreign, F.raise_error(F.lit("changes take away rows that no state holds")))
        .otherwise(F.col("n_rows"))
        .cast("long")
        .alias("n_rows"),
        "n_values",
        "n_odd",
        F.when(F.col("n_values") > F.col("n_odd"), F.col("total")).alias("total"),
        F.when(F.col("n_odd") > 0, F.col("odd_total")).alias("odd_total"),
        F.when(has_values, F.least("low", "come_low")).alias("low"),
        F.when(has_values, F.greatest("high", "come_high")).alias("high"),
        (touched & has_values & (lost | (F.col("n_odd") > 0))).alias("stale"),
    ).where(F.col("n_rows") > 0)


def replaced(
    held: DataFrame, before: DataFrame, after: DataFrame, fact: DataFrame
) -> DataFrame:
    """States once the fact rows ``before`` gave way to ``after``.

    ``fact`` is the fact as it is now, or its days that hold changes; of it only the groups
    that are stale are read again, found by a semi-join on their keys.
    """
    found = merged(held, changes(before, after))
    stale = found.where("stale").select(*(F.col(k).alias(f"stale_{k}") for k in KEYS))
    source = F.when(F.expr(KNOWN_GENERATION), F.col("energy_source"))
    rows = fact.withColumn("state_source", source)
    own = {k: "state_source" if k == "energy_source" else k for k in KEYS}
    same = reduce(
        lambda a, b: a & b,
        (F.col(own[k]).eqNullSafe(F.col(f"stale_{k}")) for k in KEYS),
    )
    again = states(rows.join(stale, same, "left_semi").drop("state_source"))
    return found.where(~F.col("stale")).drop("stale").unionByName(again)


def _total() -> Column:
    """Null where there is no value; a group's units add up."""
    exact, odd = F.sum("total").cast("double"), F.sum("odd_total")
    return F.when(exact.isNotNull() & odd.isNotNull(), exact + odd).otherwise(
        F.coalesce(exact, odd)
    )


def load_daily(held: DataFrame) -> DataFrame:
    return (
        held.where(DEMAND)
        .groupBy("region", "region_name", "observation_date")
        .agg(
            F.try_divide(_total(), F.sum("n_values")).alias("avg_load"),
            F.min("low").alias("min_load"),
            F.max("high").alias("max_load"),
            _total().alias("total_load"),
            F.min("unit").alias("unit"),
        )
        .select(*AGG_LOAD_DAILY.fieldNames())
    )


def generation_mix(held: DataFrame) -> DataFrame:
    return (
        held.where(KNOWN_GENERATION)
        .groupBy("region", "region_name", "observation_date", "energy_source")
        .agg(_total().alias("daily_total_generation"), F.min("unit").alias("unit"))
        .select(*AGG_GENERATION_MIX.fieldNames())
    )
