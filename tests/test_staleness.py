"""Status changes of a stream with gaps against the batch rule."""

from __future__ import annotations

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import utc
from wattlane.functions.status import source_status
from wattlane.streaming import staleness

START = datetime(2025, 11, 14)


def observed(spark, hours):
    rows = [(region, START + timedelta(hours=h)) for region, h in hours]
    frame = pd.DataFrame(rows, columns=["region", "observation_timestamp"])
    return spark.createDataFrame(frame, "region string, observation_timestamp timestamp")


def changes(rows):
    return sorted((r.source, (r.changed_at - START) / timedelta(hours=1), r.status) for r in rows)


def test_rule_at_its_edges(spark):
    """Six hours of silence pass, as do twelve without an error."""
    hours = [("A", 0), ("A", 6), ("A", 18), ("A", 40), ("A", 40), ("B", 1), (None, 3), ("C", 41)]
    found = staleness.past_status_changes(observed(spark, hours), utc("2025-11-15T18:00:00"))
    assert changes(found.collect()) == [
        ("A", 0, "pass"), ("A", 12, "warn"), ("A", 18, "pass"), ("A", 24, "warn"),
        ("A", 30, "error"), ("A", 40, "pass"), ("B", 1, "pass"), ("B", 7, "warn"),
        ("B", 13, "error"), ("C", 41, "pass"),
    ]


def test_changes_are_those_of_the_check_at_any_time(spark):
    hours = [("A", h) for h in (0, 1, 5, 14, 15, 40, 47)]
    end = utc("2025-11-16T12:00:00")
    told = changes(staleness.past_status_changes(observed(spark, hours), end).collect())
    for check in range(60):
        at = START + timedelta(hours=check, minutes=30)
        newest = max(START + timedelta(hours=h) for _, h in hours if h <= check)
        by_rule = spark.range(1).select(
            source_status(spark_time(newest), spark_time(at)).alias("status")
        ).first().status
        assert [status for _, hour, status in told if hour <= check][-1] == by_rule


def spark_time(moment):
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


@pytest.mark.parametrize("parts", [1, 3])
def test_stream_tells_the_same(spark, tmp_path, parts):
    """Rows repeat and come out of order within the delay; a source falls silent for good."""
    hours = [("A", h) for h in (0, 1, 3, 2, 12, 11, 30, 30, 31, 33, 32, 60, 90)]
    hours += [("B", h) for h in (2, 1, 9, 60)] + [("C", 4)] + [(None, 5)]
    hours.sort(key=lambda row: row[1] + (1.5 if row[1] % 2 else 0))
    size = -(-len(hours) // parts)
    root = str(tmp_path)
    for at in range(0, len(hours), size):
        observed(spark, hours[at : at + size]).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema("region string, observation_timestamp timestamp")
        told = staleness.status_changes(stream.parquet(f"{root}/in"))
        query = told.writeStream.format("parquet").option("checkpointLocation", f"{root}/progress")
        query.trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    expected = staleness.past_status_changes(observed(spark, hours), utc("2025-11-17T16:00:00"))
    assert changes(spark.read.parquet(f"{root}/out").collect()) == changes(expected.collect())
