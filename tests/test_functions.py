from __future__ import annotations

import hashlib
from datetime import UTC, date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import utc
from wattlane.functions import metrics, periods, scoring, status
from wattlane.functions.arguments import (
    InvalidRequest,
    check_budget,
    check_dates,
    check_granularity,
    check_limit,
    check_region,
    closed_days,
    coerce_utc,
)
from wattlane.window import BatchWindow, hourly_windows

PERIODS = {
    "2025-11-14T05": utc("2025-11-14T05:00:00"),
    "2025-11-14": utc("2025-11-14T00:00:00"),
    "2025-11-14T05:06:07Z": utc("2025-11-14T05:06:07"),
    "2025-11-14T05:06:07+00:00": utc("2025-11-14T05:06:07"),
    "2025-11-14T05:06:07.25+02:00": utc("2025-11-14T03:06:07.250"),
    "2025-11-14T05:06:07.123456-0130": utc("2025-11-14T06:36:07.123456"),
    # The full layout needs its offset.
    "2025-11-14T05:06:07": None,
    "2025-11-14T24": None,
    "2025-11-14T": None,
    "2025-11-14T05Z": None,
    "2025-11-14T05 Europe/Paris": None,
    "2026-02-30T05": None,
    "T05": None,
    "2026-03T05": None,
    " 2026-3-7T5 ": utc("2026-03-07T05:00:00"),
    "2026-13-01": None,
    "27/03/2026": None,
    "soon": None,
    "": None,
}


def test_period_layouts(spark):
    frame = spark.createDataFrame([(text,) for text in [*PERIODS, None]], "period string")
    parsed = frame.select("period", F.unix_micros(periods.parse_period(F.col("period"))))
    found = {row[0]: row[1] for row in parsed.collect()}
    epoch = datetime(1970, 1, 1, tzinfo=UTC)
    expected = {
        text: None if moment is None else (moment - epoch) // timedelta(microseconds=1)
        for text, moment in PERIODS.items()
    }
    assert found == expected | {None: None}


def test_date_ranges_join_consecutive_days():
    days = [date(2026, 1, 3), date(2026, 1, 1), date(2026, 1, 2), date(2026, 1, 9)]
    assert periods.date_ranges(days) == [
        (date(2026, 1, 1), date(2026, 1, 3)),
        (date(2026, 1, 9), date(2026, 1, 9)),
    ]


def test_in_dates_of_nothing_keeps_nothing(spark):
    frame = spark.sql("select date '2026-01-01' as d")
    assert frame.where(periods.in_dates(F.col("d"), [])).count() == 0


def test_history_reaches_over_month_ends():
    assert min(periods.with_history([date(2026, 3, 3)], 7)) == date(2026, 2, 24)


@pytest.mark.parametrize(
    ("fueltype", "type_", "type_name", "name", "source"),
    [
        (None, "D", "Demand", "demand", None),
        (None, "d", "Anything", "demand", None),
        (None, "XX", "DEMAND", "demand", None),
        (None, "DF", "Day-ahead demand forecast", "day_ahead_demand_forecast", None),
        (None, "NG", "Net generation", "net_generation", None),
        ("ng", "generation", "Generation", "generation", "NG"),
        ("\tsun ", "generation", "Generation", "generation", "SUN"),
        ("  ", "D", "Demand", "generation", None),
        (None, "x", "-Odd  label!", "_odd_label_", None),
    ],
)
def test_metric_names_and_sources(spark, fueltype, type_, type_name, name, source):
    frame = spark.createDataFrame(
        [(fueltype, type_, type_name)], "fueltype string, type string, type_name string"
    )
    row = frame.select(
        metrics.metric_name(F.col("fueltype"), F.col("type"), F.col("type_name")),
        metrics.energy_source(F.col("fueltype")),
    ).first()
    assert tuple(row) == (name, source)


@pytest.mark.parametrize(
    ("moment", "text"),
    [
        ("2025-11-14T05:00:00", "2025-11-14 05:00:00+00"),
        ("2025-11-14T05:00:00.250", "2025-11-14 05:00:00.250+00"),
        ("2025-11-14T05:00:00.000001", "2025-11-14 05:00:00.000001+00"),
    ],
)
def test_surrogate_key_text(spark, moment, text):
    key = metrics.surrogate_key(
        F.lit("NRTH"), metrics.timestamp_text(F.lit(utc(moment))), F.lit("demand"), F.lit(None)
    )
    expected = hashlib.md5(f"NRTH-{text}-demand-_dbt_utils_surrogate_key_null_".encode())
    assert spark.range(1).select(key).first()[0] == expected.hexdigest()


@pytest.mark.parametrize(
    ("moment", "freshness", "source"),
    [
        ("2025-11-14T05:00:00", "fresh", "pass"),
        ("2025-11-14T04:59:59.999999", "stale", "warn"),
        ("2025-11-13T23:59:59", "stale", "warn"),
        ("2025-11-13T23:00:00", "stale", "warn"),
        ("2025-11-13T22:59:59.999999", "stale", "error"),
        ("2025-11-15T00:00:00", "fresh", "pass"),
        (None, "unknown", "error"),
    ],
)
def test_freshness_thresholds(spark, moment, freshness, source):
    checked = F.lit(utc("2025-11-14T11:00:00"))
    stamp = F.lit(utc(moment)) if moment else F.lit(None).cast("timestamp")
    row = spark.range(1).select(
        status.freshness_status(stamp, checked), status.source_status(stamp, checked)
    )
    assert tuple(row.first()) == (freshness, source)


@pytest.mark.parametrize(
    ("pipeline", "data", "combined"),
    [
        ("fresh", "fresh", "fresh"),
        ("stale", "fresh", "stale"),
        ("unknown", "stale", "stale"),
        (None, "stale", "stale"),
        ("fresh", "unknown", "unknown"),
        ("fresh", None, "unknown"),
        ("late", "fresh", "unknown"),
    ],
)
def test_combined_status(spark, pipeline, data, combined):
    column = status.combined_status(F.lit(pipeline).cast("string"), F.lit(data).cast("string"))
    assert spark.range(1).select(column).first()[0] == combined


@pytest.mark.parametrize(
    ("current", "baseline", "deviation", "flag"),
    [
        (150.0, 100.0, 50.0, False),
        (150.5, 100.0, 50.5, True),
        (49.0, 100.0, -51.0, True),
        (10.0, 0.0, None, False),
        (10.0, None, None, False),
        (None, 100.0, None, False),
    ],
)
def test_deviation_and_flag(spark, current, baseline, deviation, flag):
    frame = spark.createDataFrame([(current, baseline)], "c double, b double")
    pct = scoring.pct_deviation(F.col("c"), F.col("b"))
    row = frame.select(pct, scoring.anomaly_flag(pct)).first()
    assert tuple(row) == (deviation, flag)


def test_share_rounds_half_up_and_survives_a_zero_total(spark):
    frame = spark.createDataFrame([(75.0, 100.0), (1.0, 3.0), (0.0, 0.0)], "v double, t double")
    found = [row[0] for row in frame.select(scoring.share_pct(F.col("v"), F.col("t"))).collect()]
    assert found == [75.0, 33.33, 0.0]


def test_utc_coercion():
    plus_two = timezone(timedelta(hours=2))
    expected = utc("2025-11-14T00:00:00")
    assert coerce_utc("2025-11-14T00:00:00Z") == expected
    assert coerce_utc("2025-11-14T02:00:00+02:00") == expected
    assert coerce_utc(datetime(2025, 11, 14)) == expected
    assert coerce_utc(datetime(2025, 11, 14, 2, tzinfo=plus_two)) == expected


def test_argument_checks():
    with pytest.raises(InvalidRequest):
        check_region("  ")
    with pytest.raises(InvalidRequest):
        check_dates(date(2026, 1, 2), date(2026, 1, 1))
    with pytest.raises(InvalidRequest):
        check_limit(0)
    with pytest.raises(InvalidRequest):
        check_granularity("weekly")
    with pytest.raises(InvalidRequest):
        check_budget(501, 500, "load")
    check_budget(500, 500, "load")
    check_budget(10**9, None, "load")
    assert closed_days(date(2025, 11, 7), date(2025, 11, 15)) == 9


def test_windows():
    batch = BatchWindow.of("2025-11-14T00:00:00Z", "2025-11-14T01:00:00+00:00")
    assert batch.batch_id == "20251114T000000_20251114T010000"
    assert batch.batch_date == date(2025, 11, 14)
    assert BatchWindow.from_batch_id(batch.batch_id) == batch
    with pytest.raises(InvalidRequest):
        BatchWindow.of("2025-11-14", "2025-11-14")
    hours = hourly_windows("2025-11-13T22:00:00", "2025-11-14T01:00:00")
    assert [w.start.hour for w in hours] == [22, 23, 0]
    with pytest.raises(InvalidRequest):
        hourly_windows("2025-11-13T22:30:00", "2025-11-14T01:00:00")
