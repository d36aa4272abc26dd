"""Staging, marts, scoring and checks on small hand-made rows."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import generation_row, raw_row, rows_of, utc
from wattlane.operators import anomalies, control, marts, quality, staging
from wattlane.schemas import METRICS
from wattlane.window import BatchWindow

FIRST = BatchWindow.of("2025-11-14T00:00:00", "2025-11-14T01:00:00")
SECOND = BatchWindow.of("2025-11-14T01:00:00", "2025-11-14T02:00:00")


def staged_frame(spark, rows):
    """Staged rows from (region, name, timestamp, metric, value, source, unit, ingested)."""
    values = [
        (r, n, utc(ts), utc(ts).date(), m, v, s, u, f"{r}{ts}{m}{s}", utc(ing))
        for r, n, ts, m, v, s, u, ing in rows
    ]
    return spark.createDataFrame(values, METRICS)


def test_unparsable_periods_stay_for_the_checks(raw_frame):
    raw = raw_frame([raw_row(FIRST), raw_row(FIRST, period="soon")])
    assert rows_of(staging.canonicalise(raw), "observation_date") == [
        (None,),
        (date(2025, 11, 14),),
    ]
    assert rows_of(staging.observation_dates(raw)) == [(date(2025, 11, 14),)]


def test_staged_row_is_canonical(raw_frame):
    raw = raw_frame([generation_row(FIRST, " ng ", 5.0, value_units=" MegawattHours\t")])
    row = staging.canonicalise(raw).first()
    assert (row["region"], row["energy_source"], row["unit"]) == ("NRTH", "NG", "megawatthours")
    assert row["metric_name"] == "generation"
    assert row["observation_timestamp"].hour == 0


def test_newest_ingestion_wins_but_its_duplicates_stay(raw_frame):
    late = {"period": "2025-11-14T00"}
    raw = raw_frame(
        [
            raw_row(FIRST, value=1.0),
            raw_row(SECOND, value=2.0, **late),
            raw_row(SECOND, value=3.0, **late),
            raw_row(FIRST, value=9.0, respondent="ERCO"),
        ]
    )
    kept = staging.newest_batch(staging.canonicalise(raw))
    assert rows_of(kept, "region", "metric_value") == [("ERCO", 9.0), ("NRTH", 2.0), ("NRTH", 3.0)]


def test_region_name_of_newest_ingestion_then_observation_then_name(spark):
    at = "2025-11-14T00:00:00"
    staged = staged_frame(
        spark,
        [
            ("A", "old", "2025-11-14T05:00:00", "demand", 1.0, None, "mwh", at),
            ("A", "new", "2025-11-14T01:00:00", "demand", 1.0, None, "mwh", "2025-11-14T02:00:00"),
            ("B", "early", "2025-11-14T01:00:00", "demand", 1.0, None, "mwh", at),
            ("B", "late", "2025-11-14T02:00:00", "demand", 1.0, None, "mwh", at),
            ("C", "x", "2025-11-14T01:00:00", "demand", 1.0, None, "mwh", at),
            ("C", "y", "2025-11-14T01:00:00", "demand", 1.0, None, "mwh", at),
        ],
    )
    assert rows_of(marts.dim_region(staged)) == [("A", "new"), ("B", "late"), ("C", "y")]


@pytest.fixture
def day(spark):
    at = "2025-11-15T00:00:00"
    return staged_frame(
        spark,
        [
            ("A", "Alpha", "2025-11-14T00:00:00", "demand", 10.0, None, "mwh", at),
            ("A", "Alpha", "2025-11-14T01:00:00", "demand", 30.0, None, "gwh", at),
            ("A", "Alpha", "2025-11-14T02:00:00", "demand", None, None, "mwh", at),
            ("A", "Renamed", "2025-11-14T03:00:00", "demand", 40.0, None, "mwh", at),
            ("B", "Beta", "2025-11-14T00:00:00", "demand", 40.0, None, "mwh", at),
            ("B", "Beta", "2025-11-14T00:00:00", "generation", 7.0, "NG", "mwh", at),
            ("B", "Beta", "2025-11-14T01:00:00", "generation", 8.0, "NG", "mwh", at),
            ("B", "Beta", "2025-11-14T01:00:00", "generation", 5.0, None, "mwh", at),
        ],
    )


def test_daily_load_splits_a_renamed_region_and_skips_nulls(day):
    found = rows_of(
        marts.load_daily(day),
        "region", "region_name", "avg_load", "min_load", "max_load", "total_load", "unit",
    )
    assert found == [
        ("A", "Alpha", 20.0, 10.0, 30.0, 40.0, "gwh"),
        ("A", "Renamed", 40.0, 40.0, 40.0, 40.0, "mwh"),
        ("B", "Beta", 40.0, 40.0, 40.0, 40.0, "mwh"),
    ]


def test_a_day_of_null_values_has_null_figures(spark):
    only = ("A", "Alpha", "2025-11-14T00:00:00", "demand", None, None, "mwh", "2025-11-14T01:00:00")
    row = marts.load_daily(staged_frame(spark, [only])).first()
    assert (row["avg_load"], row["total_load"]) == (None, None)


def test_generation_mix_leaves_out_unknown_sources(day):
    mix = marts.generation_mix(day)
    assert rows_of(mix, "energy_source", "daily_total_generation") == [("NG", 15.0)]
    assert rows_of(marts.dim_energy_source(day)) == [("NG",)]


def test_hourly_load_keeps_every_demand_row(day):
    assert marts.load_hourly(day).count() == 5


def test_equal_totals_rank_by_region_and_share_only_within_it(day):
    ranks = marts.top_regions(marts.load_daily(day))
    assert rows_of(ranks, "region", "region_name", "rank") == [
        ("A", "Alpha", 1),
        ("A", "Renamed", 1),
        ("B", "Beta", 3),
    ]


def metrics_frame(spark, rows):
    return spark.createDataFrame(
        rows, "observation_date date, region string, metric_name string, current_value double"
    )


def by_join(metrics):
    """The baseline as a range self-join, to check the window against."""
    history = metrics.selectExpr(
        "observation_date as d", "region as r", "metric_name as m", "current_value as v"
    )
    day = F.col("observation_date")
    near = F.col("d").between(F.date_sub(day, 7), F.date_sub(day, 1))
    same = (F.col("r") == F.col("region")) & (F.col("m") == F.col("metric_name"))
    mean = (
        metrics.dropDuplicates(["observation_date", "region", "metric_name"])
        .join(history, same & near, "left")
        .groupBy("observation_date", "region", "metric_name")
        .agg(F.avg("v").alias("rolling_7d_avg"))
    )
    return metrics.join(mean, ["observation_date", "region", "metric_name"])


def test_baseline_equals_the_self_join_with_gaps_and_split_days(spark):
    start = date(2026, 2, 20)
    rows = []
    for n in range(40):
        if n % 5 == 3 or 15 <= n < 25:
            continue
        value = float((n * 37) % 11)
        rows.append((start + timedelta(days=n), "A", "demand", value))
        if n % 4 == 0:
            rows.append((start + timedelta(days=n), "A", "demand", value + 3))
        rows.append((start + timedelta(days=n), "B", "generation", None if n == 6 else value * 2))
    metrics = metrics_frame(spark, rows)
    columns = ["observation_date", "region", "metric_name", "current_value", "rolling_7d_avg"]
    assert rows_of(anomalies.with_baseline(metrics), *columns) == rows_of(
        by_join(metrics), *columns
    )


def test_scores_of_chosen_dates_equal_those_of_all(spark):
    start = date(2026, 3, 1)
    rows = [(start + timedelta(days=n), "A", "demand", float(n % 3) * 50) for n in range(20)]
    metrics = metrics_frame(spark, rows)
    dates = [date(2026, 3, 5), date(2026, 3, 16), date(2026, 3, 17)]
    whole = anomalies.score(metrics).where(F.col("observation_date").isin(dates))
    assert rows_of(anomalies.score(metrics, dates)) == rows_of(whole)


def test_deviation_edges(spark):
    d = date(2026, 3, 10)
    rows = [
        (d, "half", "demand", 100.0), (d + timedelta(1), "half", "demand", 150.0),
        (d, "zero", "demand", 0.0), (d + timedelta(1), "zero", "demand", 5.0),
        (d - timedelta(7), "week", "demand", 10.0), (d + timedelta(1), "week", "demand", 90.0),
        (d, "up", "demand", 100.0), (d + timedelta(1), "up", "demand", 151.0),
    ]
    scored = anomalies.score(metrics_frame(spark, rows), [d + timedelta(1)])
    assert rows_of(scored, "region", "rolling_7d_avg", "pct_deviation", "anomaly_flag") == [
        ("half", 100.0, 50.0, False),
        ("up", 100.0, 51.0, True),
        ("week", None, None, False),
        ("zero", 0.0, None, False),
    ]


def test_latest_scores_keep_one_run(spark):
    rows = [
        (date(2026, 3, 1), "A", "demand", utc("2026-03-02T00:00:00"), "r1"),
        (date(2026, 3, 1), "A", "demand", utc("2026-03-03T00:00:00"), "r2"),
    ]
    results = spark.createDataFrame(
        rows,
        "observation_date date, region string, metric_name string, checked_at timestamp, "
        "run_id string",
    )
    assert rows_of(anomalies.latest_scores(results), "run_id") == [("r2",)]


# Checks


def test_unique_ignores_nulls_but_combinations_group_them(spark):
    rows = spark.createDataFrame(
        [(None, "t", None), (None, "t", None), ("k", "t", "NG")], "a string, b string, c string"
    )
    tables = {"x": rows}
    assert quality.violations(tables, quality.Check("x", "unique", ("a",))).count() == 0
    combined = quality.violations(tables, quality.Check("x", "unique", ("b", "c")))
    assert rows_of(combined) == [("t", None, 2)]


def test_accepted_and_reference_let_null_pass(spark):
    tables = {
        "x": spark.createDataFrame([("NG",), ("COAL",), ("COAL",), (None,)], "a string"),
        "p": spark.createDataFrame([("NG",)], "a string"),
    }
    checks = [
        quality.Check("x", "accepted", ("a",), ("NG",)),
        quality.Check("x", "reference", ("a",), parent="p"),
        quality.Check("x", "not_null", ("a",)),
    ]
    assert rows_of(quality.check_results(tables, checks)) == [
        ("x.accepted.a", 2, "fail"),
        ("x.not_null.a", 1, "fail"),
        ("x.reference.a", 2, "fail"),
    ]
    assert quality.violations(tables, checks[0]).count() == 2


@pytest.mark.parametrize(("hours", "expected"), [(6, "pass"), (7, "warn"), (13, "error")])
def test_source_freshness(raw_frame, hours, expected):
    raw = raw_frame([raw_row(FIRST)])
    found = quality.source_freshness(raw, FIRST.end + timedelta(hours=hours)).first()
    assert (found["age_seconds"], found["status"]) == (hours * 3600, expected)


def test_nothing_loaded_is_an_error(raw_frame):
    assert quality.source_freshness(raw_frame([]), FIRST.end).first()["status"] == "error"


def test_freshness_row(spark):
    signals = spark.createDataFrame(
        [(utc("2025-11-14T08:00:00"), utc("2025-11-14T04:30:00"))],
        "pipeline_freshness_timestamp timestamp, data_freshness_timestamp timestamp",
    )
    row = control.freshness_row(signals, "manual", utc("2025-11-14T11:00:00")).first()
    assert (row["pipeline_freshness_status"], row["data_freshness_status"]) == ("fresh", "stale")


def test_run_result_documents(spark, tmp_path):
    from wattlane.schemas import RUN_RESULTS

    (tmp_path / "run_results.json").write_text(
        """{"results": [
        {"unique_id": "model.a", "status": "success", "adapter_response": {"bytes_processed": 10}},
        {"unique_id": "model.b", "status": "error", "adapter_response": {}},
        {"unique_id": "test.c", "status": "pass", "adapter_response": null},
        {"unique_id": "test.d", "status": "success"},
        {"unique_id": "test.e", "status": "fail", "adapter_response": {"bytes_processed": 5}},
        {"unique_id": "test.f", "status": "warn"},
        {"unique_id": "seed.g", "status": "success"}]}"""
    )
    documents = spark.read.schema(RUN_RESULTS).json(str(tmp_path), multiLine=True)
    totals = control.check_totals(control.run_result_rows(documents))
    assert tuple(totals.first()) == (1, 2, 1, 15)
    none = control.check_totals(control.run_result_rows(documents.limit(0)))
    assert tuple(none.first()) == (0, 0, 0, 0)
