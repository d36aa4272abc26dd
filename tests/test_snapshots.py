"""Snapshots compared by the fingerprints of their partitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import rows_of
from wattlane.operators import snapshots

SCHEMA = "day string, name string, other string, value double"


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


ROWS = [(f"d{k % 4}", f"n{k}", None, float(k)) for k in range(40)] + [(None, "n", "o", None), (None, "n", "o", None)]


def both(spark, after):
    before, after = frame(spark, ROWS), frame(spark, after, 5)
    found = snapshots.partition_differences(before, after, "day")
    assert rows_of(found) == rows_of(snapshots.differences(before, after))
    return snapshots.unlike_partitions(before, after, "day")


def test_rows_in_any_order_are_alike(spark):
    assert both(spark, ROWS[::-1]) == []


def test_one_changed_row_is_found(spark):
    changed = list(ROWS)
    changed[6] = ("d2", "n6", None, 6.5)
    assert both(spark, changed) == ["d2"]


def test_a_null_that_moves_a_copy_less_and_partitions_of_one_side(spark):
    moved = [("d1", None, "n1", 1.0) if r[1] == "n1" else r for r in ROWS]
    assert both(spark, moved) == ["d1"]
    assert both(spark, ROWS[:-1]) == [None]
    assert both(spark, ROWS + [("new", "n", None, 1.0)]) == ["new"]
    assert sorted(both(spark, []), key=str) == [None, "d0", "d1", "d2", "d3"]


def test_only_unlike_partitions_are_read(spark, tmp_path):
    frame(spark, ROWS).where("day is not null").write.partitionBy("day").parquet(str(tmp_path / "rows"))
    before = spark.read.parquet(str(tmp_path / "rows")).select("day", "name", "other", "value")
    after = before.withColumn("value", F.when(F.col("name") == "n6", 0.5).otherwise(F.col("value")))
    found = snapshots.partition_differences(before, after, "day")
    assert rows_of(found, "side", "name", "value") == [("after", "n6", 0.5), ("before", "n6", 6.0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [(day") + plan.count("PartitionFilters: [isnotnull(day") >= 2
