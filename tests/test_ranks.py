"""Ranks in ranges against one window a group."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wattlane.operators.ranks import ranked_in_ranges


@pytest.mark.parametrize("range_rows", [1, 7, 10**6])
def test_same_ranks_as_a_window(spark, range_rows):
    """One group with most rows, ties, nulls everywhere and values that are no numbers."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 11 > 0, F.lit("hot")).when(F.col("id") % 2 == 0, "small").alias("day"),
        F.when(F.col("id") % 13 == 0, F.lit(None))
        .when(F.col("id") % 17 == 0, F.lit(float("nan")))
        .when(F.col("id") % 5 == 0, F.lit(7.5))
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(400)).cast("double"))
        .alias("total"),
        F.when(F.col("id") % 19 > 0, F.concat(F.lit("r"), F.col("id") % 50)).alias("code"),
        "id",
    )
    found = ranked_in_ranges(rows, group="day", value="total", name="code", range_rows=range_rows)
    order = Window.partitionBy("day").orderBy(F.col("total").desc(), F.col("code"))
    expected = rows.withColumn("rank", F.rank().over(order).cast("long"))
    assert found.columns == expected.columns
    assert Counter(repr(tuple(r)) for r in found.collect()) == Counter(
        repr(tuple(r)) for r in expected.collect()
    )


def test_a_group_is_ordered_by_many_tasks(spark):
    rows = spark.range(20_000).selectExpr("1 as day", "id as total", "'r' as code")
    found = ranked_in_ranges(rows, group="day", value="total", name="code", range_rows=100)
    assert found.where(F.col("rank") + F.col("total") != 20_000).count() == 0
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "rank(" not in plan and "__range" in plan


def test_nothing_is_ranked_of_nothing(spark):
    rows = spark.range(0).selectExpr("1 as day", "id as total", "'r' as code")
    assert ranked_in_ranges(rows, group="day", value="total", name="code").count() == 0
