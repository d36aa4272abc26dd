from __future__ import annotations

import math
import random

import pytest

from pyspark.sql import functions as F

from wattlane.operators.latency import _bands, _counted, latency_summary, narrowed


def interpolated(values, p):
    ordered = sorted(values)
    at = (len(ordered) - 1) * p
    low, high = math.floor(at), math.ceil(at)
    return ordered[low] + (ordered[high] - ordered[low]) * (at - low)


def expected(values):
    return (
        float(len(values)),
        math.fsum(values) / len(values) * 1000,
        interpolated(values, 0.50) * 1000,
        interpolated(values, 0.95) * 1000,
        interpolated(values, 0.99) * 1000,
        min(values) * 1000,
        max(values) * 1000,
    )


def test_exact_percentiles_per_group(spark):
    rng = random.Random(5)
    groups = {
        "one": [0.25],
        "two": [1.0, 2.0],
        "known": [1.0, 2.0, 4.0, 9.0],
        "copies": [0.5] * 900 + [0.75] * 100,
        "mixed": [rng.lognormvariate(0, 2) for _ in range(2000)],
        "signed": [rng.uniform(-3, 3) for _ in range(501)] + [0.0, -0.0],
        None: [rng.uniform(0, 1e6) for _ in range(50)],
    }
    rows = [(key, value) for key, values in groups.items() for value in values]
    rows += [("one", None)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "endpoint string, seconds double").repartition(3)
    summary = latency_summary(frame, ["endpoint"], "seconds").collect()
    found = {row[0]: tuple(row)[1:] for row in summary}
    assert found.keys() == groups.keys()
    for key, values in groups.items():
        assert found[key] == pytest.approx(expected(values), rel=1e-12, abs=1e-9), key


def test_by_two_columns(spark):
    rows = [("a", 1, 1.0), ("a", 1, 3.0), ("a", 2, 5.0)]
    frame = spark.createDataFrame(rows, "endpoint string, status int, seconds double")
    found = latency_summary(frame, ["endpoint", "status"], "seconds").orderBy("status").collect()
    assert [(row["status"], row["p50_ms"]) for row in found] == [(1, 2000.0), (2, 5000.0)]


def test_close_values_are_not_ordered_in_one_task(spark):
    """A third of a group in one value, the rest unlike and within 30 ms."""
    value = F.when(F.col("id") % 3 == 0, 0.02).otherwise(F.rand(3) * 0.03)
    frame = spark.range(400_000).select(F.lit("a").alias("endpoint"), value.alias("seconds"))
    counted = _counted(frame, ["endpoint"], "seconds")
    left = narrowed(counted, _bands(counted, ["endpoint"]), ["endpoint"])
    sizes = left.groupBy("band", "part").count().agg(F.max("count")).first()[0]
    assert sizes < 400
    row = latency_summary(frame, ["endpoint"], "seconds").first()
    exact = frame.select(F.percentile("seconds", [0.5, 0.95, 0.99])).first()[0]
    assert [row["p50_ms"], row["p95_ms"], row["p99_ms"]] == pytest.approx([x * 1000 for x in exact])
