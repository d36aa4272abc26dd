"""Read queries over hand-made tables."""

from __future__ import annotations

from datetime import date, timedelta

import pytest

from tests.conftest import rows_of, utc
from wattlane import schemas
from wattlane.functions.arguments import InvalidRequest
from wattlane.plans import serving

D = date(2025, 11, 15)
CHECKED = utc("2025-11-15T10:15:00")


def anomaly(day, region, flagged, metric="demand", run="r1", checked_at=CHECKED):
    return (day, region, metric, 100.0, 90.0, 10.0, flagged, run, checked_at)


@pytest.fixture
def tables(spark):
    rows = {
        "dim_region": [("CISO", "California ISO"), ("ERCO", "ERCOT"), ("NRTH", "Erco")],
        "dim_energy_source": [("WND",), ("SUN",)],
        "agg_load_hourly": [
            ("ERCO", "ERCOT", utc(f"2025-11-15T0{hour}:00:00"), D, load, "mwh")
            for hour, load in enumerate([5.0, 9.0, 9.0, 1.0])
        ],
        "agg_load_daily": [
            ("ERCO", "ERCOT", D - timedelta(days=n), 10.0, 5.0, 20.0, load, "mwh")
            for n, load in enumerate([240.0, 300.0, 300.0])
        ],
        "agg_generation_mix": [
            ("ERCO", "ERCOT", D, "WND", 75.0, "mwh"),
            ("ERCO", "ERCOT", D, "SUN", 25.0, "mwh"),
            ("ERCO", "ERCOT", D - timedelta(days=1), "WND", 0.0, "mwh"),
            ("ERCO", "ERCOT", D - timedelta(days=1), "NUC", 0.0, "mwh"),
        ],
        "agg_top_regions": [
            (D - timedelta(days=n), region, region.title(), 100.0 - rank, rank)
            for n in range(3)
            for rank, region in enumerate(["ERCO", "CISO", "NRTH"], start=1)
        ],
        "pipeline_state": [("eia_grid_batch", CHECKED, CHECKED, "run-1", CHECKED)],
        "freshness_log": [
            ("r1", CHECKED, None, "fresh", "fresh", CHECKED - timedelta(hours=1)),
            ("r2", CHECKED, CHECKED, "fresh", "stale", CHECKED),
        ],
        "anomaly_results": [
            anomaly(D, "ERCO", True),
            anomaly(D, "NRTH", False),
            anomaly(D - timedelta(days=6), "ERCO", True),
            anomaly(D - timedelta(days=6), "CISO", True, "generation"),
            anomaly(D, "ERCO", True, run="r2", checked_at=CHECKED + timedelta(hours=1)),
            anomaly(D - timedelta(days=7), "PJM", True),
        ],
    }
    return {
        name: spark.createDataFrame(values, schemas.TABLES[name].schema)
        for name, values in rows.items()
    }


@pytest.fixture
def empty(spark):
    return {
        name: spark.createDataFrame([], table.schema) for name, table in schemas.TABLES.items()
    }


def test_load_in_time_order_and_its_summary(tables):
    hourly = serving.load_metrics(tables, "ERCO", D, D, "hourly")
    assert [row["hourly_load"] for row in hourly.collect()] == [5.0, 9.0, 9.0, 1.0]
    summary = serving.load_summary(hourly).first()
    assert (summary["min_load"], summary["max_load"]) == (1.0, 9.0)
    # The earliest of two equal peaks.
    assert summary["peak_timestamp"].hour == 1
    daily = serving.load_metrics(tables, "ERCO", D - timedelta(days=2), D)
    assert tuple(serving.load_summary(daily).first()) == (240.0, 300.0, D - timedelta(days=2))


def test_empty_results_are_not_errors(tables, empty):
    nothing = serving.load_metrics(tables, "CISO", D, D)
    assert nothing.count() == 0
    assert serving.load_summary(nothing).count() == 0
    assert serving.generation_mix(empty, "CISO", D, D, shares=True).count() == 0
    assert serving.dominant_source(serving.generation_mix(empty, "CISO", D, D)).count() == 0
    assert serving.date_bounds(empty).first()["start_date"] is None


def test_shares_of_the_day(tables):
    mix = serving.generation_mix(tables, "ERCO", D - timedelta(days=1), D, shares=True)
    found = [(row["energy_source"], row["generation_share_pct"]) for row in mix.collect()]
    assert found == [("NUC", 0.0), ("WND", 0.0), ("SUN", 25.0), ("WND", 75.0)]


def test_dominant_source_and_its_tie(tables):
    mix = serving.generation_mix(tables, "ERCO", D - timedelta(days=1), D)
    assert tuple(serving.dominant_source(mix).first()) == ("WND", 75.0)
    tie = serving.generation_mix(tables, "ERCO", D - timedelta(days=1), D - timedelta(days=1))
    assert serving.dominant_source(tie).first()["energy_source"] == "NUC"


def test_top_regions_by_stored_rank(tables):
    rows = serving.top_regions(tables, D - timedelta(days=1), D, 2).collect()
    assert [(row["observation_date"], row["rank"]) for row in rows] == [
        (D - timedelta(days=1), 1),
        (D - timedelta(days=1), 2),
        (D, 1),
        (D, 2),
    ]


def test_argument_errors(tables):
    with pytest.raises(InvalidRequest):
        serving.load_metrics(tables, "ERCO", D, D - timedelta(days=1))
    with pytest.raises(InvalidRequest):
        serving.generation_mix(tables, " ", D, D)
    with pytest.raises(InvalidRequest):
        serving.top_regions(tables, D, D, 0)
    with pytest.raises(InvalidRequest):
        serving.anomalies(tables, start=D, end=D - timedelta(days=1))
    with pytest.raises(InvalidRequest):
        serving.load_metrics(tables, "ERCO", D, D, "weekly")


def test_region_lookup_prefers_codes(tables):
    assert serving.resolve_region(tables, " erco ") == ("ERCO", "ERCOT")
    assert serving.resolve_region(tables, "california iso") == ("CISO", "California ISO")
    with pytest.raises(InvalidRequest) as unknown:
        serving.resolve_region(tables, "nowhere")
    assert "codes that are known" in unknown.value.hint
    assert "CISO, ERCO, NRTH" in unknown.value.hint


def test_region_lookup_of_many(spark, tables):
    asked = [("erco",), (" Ercot ",), ("CALIFORNIA iso\t",), ("nowhere",), (None,)]
    requests = spark.createDataFrame(asked, "requested string")
    found = serving.match_regions(requests, tables["dim_region"]).collect()
    assert {row["requested"]: row["region"] for row in found} == {
        "erco": "ERCO",
        " Ercot ": "ERCO",
        "CALIFORNIA iso\t": "CISO",
        "nowhere": None,
        None: None,
    }


def test_budgets(tables):
    most = {"max_rows": 60}
    with pytest.raises(InvalidRequest, match="more than the 3 allowed"):
        days = D - timedelta(days=3)
        serving.bounded_load(tables, "ERCO", days, D, "hourly", max_hourly_days=3)
    with pytest.raises(InvalidRequest, match="more than the 60 allowed"):
        serving.bounded_load(tables, "ERCO", D - timedelta(days=60), D, **most)
    with pytest.raises(InvalidRequest, match="more than the 60 allowed"):
        serving.bounded_generation_mix(tables, "ERCO", D - timedelta(days=60), D, **most)
    with pytest.raises(InvalidRequest, match="more than the 60 allowed"):
        serving.bounded_top_regions(tables, D - timedelta(days=12), D, 5, **most)
    assert serving.bounded_load(tables, "ercot", D - timedelta(days=59), D, **most).count() == 3
    assert serving.bounded_load(tables, "erco", D - timedelta(days=900), D, "hourly").count() == 4
    mix = serving.bounded_generation_mix(tables, "ERCO", D - timedelta(days=900), D)
    assert mix.count() == 4


def test_latest_freshness_and_state(tables, empty):
    latest = serving.latest_freshness(tables).first()
    assert latest["freshness_status"] == "stale"
    assert latest["data_freshness_status"] == "stale"
    unknown = serving.latest_freshness(empty).first()
    assert unknown["freshness_status"] == "unknown"
    assert unknown["pipeline_freshness_status"] == "unknown"
    assert unknown["checked_at"] is None
    assert serving.latest_run_state(tables).first()["last_successful_run_id"] == "run-1"
    assert serving.latest_run_state(empty).first()["pipeline_name"] is None


def test_metadata_survives_a_missing_side(tables, empty):
    assert serving.response_metadata(tables).first()["pipeline_run_id"] == "run-1"
    half = empty | {"pipeline_state": tables["pipeline_state"]}
    row = serving.response_metadata(half).first()
    assert (row["data_as_of"], row["pipeline_run_id"], row["freshness_status"]) == (
        None,
        "run-1",
        "unknown",
    )
    assert serving.response_metadata(empty).first()["freshness_status"] == "unknown"


def test_anomaly_list_and_order(tables):
    rows = serving.anomalies(tables).collect()
    assert [(r["observation_date"], r["region"]) for r in rows] == [
        (D, "ERCO"),
        (D, "ERCO"),
        (D - timedelta(days=6), "CISO"),
        (D - timedelta(days=6), "ERCO"),
        (D - timedelta(days=7), "PJM"),
    ]
    assert rows[0]["checked_at"] > rows[1]["checked_at"]
    assert serving.anomalies(tables, flagged_only=False).count() == 6
    assert serving.anomalies(tables, "ERCO", D, D, latest_only=True).count() == 1


def test_anomaly_summary(tables, empty):
    row = serving.anomaly_summary(tables).first()
    assert row["latest_observation_date"] == D
    assert row["flagged_anomaly_count_last_7_days"] == 4
    assert row["affected_regions_last_7_days"] == 2
    assert tuple(serving.anomaly_summary(empty).first()) == (None, None, 0, 0)


def test_truncation_of_anomalies(spark, tables):
    many = [anomaly(D - timedelta(days=n // 4), "ERCO", True) for n in range(205)]
    frame = spark.createDataFrame(many, schemas.ANOMALY_RESULTS)
    rows, over = serving.bounded_anomalies(tables | {"anomaly_results": frame}, max_rows=200)
    assert (rows.count(), over) == (200, True)
    rows, over = serving.bounded_anomalies(tables | {"anomaly_results": frame})
    assert (rows.count(), over) == (205, False)
    rows, over = serving.bounded_anomalies(tables, "ercot")
    assert (rows.count(), over) == (3, False)
    assert tuple(serving.flagged_count(rows).first()) == (3, 3)


def test_data_quality_status(tables, empty):
    row = serving.data_quality_status(tables).first()
    assert row["freshness_status"] == "stale"
    assert row["pipeline_name"] == "eia_grid_batch"
    assert row["flagged_anomaly_count_last_7_days"] == 4
    assert serving.data_quality_status(empty).first()["flagged_anomaly_count_last_7_days"] == 0


def test_discovery(tables):
    bounds = serving.date_bounds(tables).first()
    assert (bounds["start_date"], bounds["end_date"]) == (D - timedelta(days=2), D)
    assert [row["region"] for row in serving.regions(tables).collect()] == ["CISO", "ERCO", "NRTH"]
    assert rows_of(serving.energy_sources(tables)) == [("SUN",), ("WND",)]
    assert tuple(serving.latest_parameters(tables["agg_load_daily"]).first()) == ("ERCO", D)
