"""Aggregates kept up by changes against a rebuild of the whole fact."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from wattlane.operators import deltas, marts
from wattlane.schemas import METRICS

FACT = METRICS


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-9)
    return a == b


def assert_same(found, expected):
    assert found.columns == expected.columns
    keys = [c for c in found.columns if c in deltas.KEYS]
    rows = [sorted(map(tuple, t.select(*keys, *t.columns).collect()), key=repr) for t in (found, expected)]
    assert len(rows[0]) == len(rows[1])
    for a, b in zip(*rows, strict=True):
        assert all(map(close, a, b)), (a, b)


def facts(spark, n, seed):
    """Rows with nulls in every column and values that are no decimals."""
    pick = lambda k: F.pmod(F.xxhash64("id", F.lit(seed * 100 + k)), F.lit(97))
    value = (
        F.when(pick(1) < 4, F.lit(None))
        .when(pick(1) == 5, F.lit(float("nan")))
        .when(pick(1) == 6, F.lit(1e300))
        .when(pick(1) == 7, F.lit(1e-13))
        .when(pick(1) < 30, F.lit(7.1))
        .otherwise(pick(2) / 7)
    )
    rows = spark.range(n).select(
        F.when(pick(3) > 5, F.concat(F.lit("R"), pick(3) % 3)).alias("region"),
        F.when(pick(4) > 5, F.concat(F.lit("N"), pick(4) % 2)).alias("region_name"),
        F.expr("timestamp'2025-11-14 00:00:00' + make_interval(0,0,0,0,cast(id % 96 as int))").alias(
            "observation_timestamp"
        ),
        F.when(pick(5) > 3, F.expr("date'2025-11-14' + cast(id % 4 as int)")).alias("observation_date"),
        F.when(pick(6) < 45, "demand").when(pick(6) < 90, "generation").when(pick(6) < 93, "other").alias(
            "metric_name"
        ),
        value.cast("double").alias("metric_value"),
        F.when(pick(7) < 80, F.concat(F.lit("S"), pick(7) % 2)).alias("energy_source"),
        F.when(pick(8) < 90, F.concat(F.lit("u"), pick(8) % 2)).alias("unit"),
        F.concat(F.lit(f"k{seed}-"), "id").alias("metric_surrogate_key"),
        F.lit(None).cast("timestamp").alias("_ingestion_timestamp"),
    )
    return rows.select(*FACT.fieldNames())


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_a_rebuild(spark, seed):
    kept, before, after = (facts(spark, n, seed * 3 + k) for k, n in enumerate((900, 120, 140)))
    now = kept.unionByName(after)
    held = deltas.states(kept.unionByName(before))
    found = deltas.replaced(held, before, after, now)
    assert_same(deltas.load_daily(found), marts.load_daily(now))
    assert_same(deltas.generation_mix(found), marts.generation_mix(now))
    again = deltas.replaced(found, after, before, kept.unionByName(before))
    assert_same(deltas.load_daily(again), marts.load_daily(kept.unionByName(before)))


def rows(spark, *given):
    values = [
        ("R", "N", None, None, "demand", value, None, "MWh", f"k{n}", None)
        for n, value in enumerate(given)
    ]
    return spark.createDataFrame(values, FACT)


def test_fact_is_read_for_lost_extremes_only(spark):
    held, none = deltas.states(rows(spark, 1.0, 5.0, 9.0)), rows(spark)
    inner = deltas.replaced(held, rows(spark, 5.0), rows(spark, 0.1, 0.2), none)
    found = deltas.load_daily(inner).first()
    assert (found.min_load, found.max_load, found.total_load) == (0.1, 9.0, 10.3)
    outer = deltas.replaced(held, rows(spark, 9.0), rows(spark, 11.0), none)
    assert deltas.load_daily(outer).first().max_load == 11.0
    lost = deltas.merged(held, deltas.changes(rows(spark, 9.0), rows(spark, 8.0)))
    assert [r.stale for r in lost.collect()] == [True]


def test_ends_of_a_group(spark):
    held, none = deltas.states(rows(spark, 1.0, 5.0)), rows(spark)
    assert deltas.replaced(held, rows(spark, 1.0, 5.0), none, none).count() == 0
    assert deltas.replaced(deltas.states(none), none, none, none).count() == 0
    only_nulls = deltas.replaced(held, rows(spark, 1.0, 5.0), rows(spark, None), none)
    found = deltas.load_daily(only_nulls).first()
    assert (found.avg_load, found.min_load, found.total_load) == (None, None, None)
    with pytest.raises(Exception, match="no state holds"):
        deltas.replaced(held, rows(spark, 1.0, 2.0, 3.0), none, none).collect()
