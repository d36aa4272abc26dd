from __future__ import annotations

import sys
from datetime import UTC, datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wattlane import Lake, prepare  # noqa: E402
from wattlane.schemas import RAW  # noqa: E402
from wattlane.window import BatchWindow  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield prepare(session)
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


HOUR = "2025-11-14T00:00:00"


def window(start: str = HOUR, end: str | None = None) -> BatchWindow:
    first = BatchWindow.of(start, "2100-01-01").start
    return BatchWindow.of(first, end or first.replace(minute=59, second=59))


def raw_row(batch: BatchWindow, **changes):
    """One landed demand row of a window, with any column changed."""
    row = {
        "respondent": "NRTH",
        "respondent_name": "Northern Grid",
        "type": "D",
        "type_name": "Demand",
        "value": 871.25,
        "value_units": "megawatthours",
        "period": f"{batch.start:%Y-%m-%dT%H}",
        "fueltype": None,
        "fueltype_name": None,
        "batch_date": batch.batch_date,
        "_batch_id": batch.batch_id,
        "_source_url": "https://example.test/region",
        "_ingestion_timestamp": batch.end,
    }
    return row | changes


def generation_row(batch: BatchWindow, fuel: str, value: float, **changes):
    return raw_row(
        batch,
        type="generation",
        type_name="Generation",
        fueltype=fuel,
        fueltype_name=fuel.title(),
        value=value,
        **changes,
    )


@pytest.fixture
def raw_frame(spark):
    def build(rows):
        values = [tuple(row[name] for name in RAW.fieldNames()) for row in rows]
        # Nullability is checked on load, not on building the frame.
        schema = RAW.__class__([f.__class__(f.name, f.dataType, True) for f in RAW.fields])
        return spark.createDataFrame(values, schema)

    return build


def rows_of(frame, *columns):
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in chosen.collect()), key=repr)
