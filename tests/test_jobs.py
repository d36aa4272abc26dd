"""Write jobs on small lakes: reruns, midnight, late and lost rows, failures."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import generation_row, raw_row, rows_of, utc
from wattlane import Lake
from wattlane.lake import SchemaDrift
from wattlane.operators import quality, snapshots
from wattlane.schemas import TABLES
from wattlane.plans import jobs, serving
from wattlane.sources.pages import read_families
from wattlane.streaming.windows import load_arriving
from wattlane.window import hourly_windows

D = date(2025, 11, 14)
DATA_TABLES = jobs.MODELS


def hour(text):
    return hourly_windows(text, utc(text) + timedelta(hours=1))[0]


ELEVEN = hour("2025-11-13T23:00:00")
MIDNIGHT = hour("2025-11-14T00:00:00")
ONE = hour("2025-11-14T01:00:00")


def window_rows(batch, demand=100.0, **changes):
    return [
        raw_row(batch, value=demand, **changes),
        generation_row(batch, "NG", 40.0, **changes),
        generation_row(batch, "sun", 20.0, **changes),
    ]


def run(lake, raw_frame, batch, rows=None, run_id="r", **options):
    frame = raw_frame(rows if rows is not None else window_rows(batch))
    checked = batch.end + timedelta(minutes=30)
    return jobs.run_window(lake, frame, batch, run_id, checked_at=checked, **options)


def load(lake, raw_frame, batch, rows=None):
    """Loading and rebuilding alone, without checks, scores and records."""
    frame = raw_frame(rows if rows is not None else window_rows(batch))
    return jobs.load_and_rebuild(lake, frame, [batch])


def snapshot_of(lake):
    return {name: rows_of(snapshots.snapshot(lake[name])) for name in DATA_TABLES}


def test_one_window_fills_every_table(lake, raw_frame):
    loaded = run(lake, raw_frame, MIDNIGHT)
    assert (loaded.rows, loaded.affected_dates) == (3, [D])
    assert all(lake[name].count() > 0 for name in DATA_TABLES)
    assert rows_of(lake["agg_generation_mix"], "energy_source") == [("NG",), ("SUN",)]
    assert lake["anomaly_results"].count() == 2
    state = lake["pipeline_state"].first()
    assert state["last_successful_run_id"] == "r"
    metrics = lake["run_metrics"].first()
    assert (metrics["status"], metrics["rows_loaded"]) == ("success", 3)
    assert metrics["dbt_models_passed"] == len(jobs.MODELS)
    assert metrics["dbt_tests_passed"] == len(quality.CHECKS)
    freshness = lake["freshness_log"].first()
    assert freshness["pipeline_freshness_status"] == "fresh"
    assert freshness["data_freshness_status"] == "fresh"


def test_rerun_changes_no_data_table(lake, raw_frame):
    run(lake, raw_frame, MIDNIGHT)
    run(lake, raw_frame, ONE)
    before = snapshot_of(lake)
    run(lake, raw_frame, ONE, run_id="again")
    assert snapshot_of(lake) == before
    # Scores are appended by every run.
    assert lake["anomaly_results"].where("run_id = 'again'").count() == 2


def test_two_hours_of_a_day_add_up_or_the_latest_replaces(spark, tmp_path, raw_frame):
    totals = {}
    for replace in (jobs.REPLACE_WINDOW, jobs.REPLACE_DAY):
        lake = Lake(spark, str(tmp_path / replace))
        for batch in (MIDNIGHT, ONE):
            rows = raw_frame(window_rows(batch))
            loaded = jobs.load_raw(lake, rows, [batch], replace)
        if replace == jobs.REPLACE_DAY:
            jobs.build_staging(lake, batch_dates=loaded.batch_dates)
        else:
            jobs.build_staging(lake, loaded.affected_dates)
        totals[replace] = (
            lake["eia_grid_batch"].count(),
            rows_of(lake["stg_grid_metrics"].where("metric_name = 'demand'"), "metric_value"),
        )
    assert totals[jobs.REPLACE_WINDOW] == (6, [(100.0,), (100.0,)])
    assert totals[jobs.REPLACE_DAY] == (3, [(100.0,)])


def test_a_run_that_replaces_its_day(lake, raw_frame):
    run(lake, raw_frame, MIDNIGHT, replace=jobs.REPLACE_DAY)
    run(lake, raw_frame, ONE, replace=jobs.REPLACE_DAY)
    assert rows_of(lake["agg_load_daily"], "total_load") == [(100.0,)]


def test_window_over_midnight_rebuilds_both_days(lake, raw_frame):
    rows = window_rows(ELEVEN) + window_rows(ELEVEN, period="2025-11-14T00")
    loaded = load(lake, raw_frame, ELEVEN, rows)
    assert loaded.affected_dates == [date(2025, 11, 13), D]
    for name in ("stg_grid_metrics", "fct_grid_metrics", "agg_load_daily", "agg_top_regions"):
        found = {row["observation_date"] for row in lake[name].collect()}
        assert found == {date(2025, 11, 13), D}, name


def test_overlapping_windows_keep_the_newest_value(lake, raw_frame):
    load(lake, raw_frame, ELEVEN, window_rows(ELEVEN, 1.0, period="2025-11-14T00"))
    load(lake, raw_frame, MIDNIGHT, window_rows(MIDNIGHT, 2.0))
    assert rows_of(lake["agg_load_daily"], "total_load") == [(2.0,)]


def test_late_rows_reach_their_old_day(lake, raw_frame):
    load(lake, raw_frame, MIDNIGHT)
    late = window_rows(ONE) + [raw_row(ONE, value=7.0, period="2025-11-10T05")]
    loaded = load(lake, raw_frame, ONE, late)
    assert loaded.affected_dates == [date(2025, 11, 10), D]
    assert rows_of(lake["agg_load_daily"], "observation_date", "total_load") == [
        (date(2025, 11, 10), 7.0),
        (D, 200.0),
    ]


def test_rows_lost_in_a_rerun_leave_every_table(lake, raw_frame):
    extra = [raw_row(MIDNIGHT, value=7.0, period="2025-11-15T00")]
    load(lake, raw_frame, MIDNIGHT, window_rows(MIDNIGHT) + extra)
    assert lake["agg_load_daily"].count() == 2
    loaded = load(lake, raw_frame, MIDNIGHT, window_rows(MIDNIGHT)[1:])
    assert loaded.affected_dates == [D, date(2025, 11, 15)]
    assert lake["stg_grid_metrics"].count() == 2
    assert lake["agg_load_daily"].count() == 0
    assert lake["agg_top_regions"].count() == 0
    assert lake["agg_generation_mix"].count() == 2


def test_unparsable_rows_are_kept_raw_and_fail_a_full_build(lake, raw_frame):
    rows = window_rows(MIDNIGHT) + [raw_row(MIDNIGHT, period="soon"), raw_row(MIDNIGHT, period="?")]
    loaded = jobs.load_raw(lake, raw_frame(rows), [MIDNIGHT])
    assert (loaded.rows, loaded.affected_dates) == (5, [D])
    jobs.rebuild(lake, loaded.affected_dates)
    assert lake["stg_grid_metrics"].count() == 3
    jobs.rebuild(lake)
    failed = jobs.run_checks(lake).where("status = 'fail'")
    assert ("stg_grid_metrics.not_null.observation_timestamp", 2) in rows_of(
        failed, "check_name", "n_broken"
    )


def test_a_window_without_any_dated_row_touches_no_day(lake, raw_frame):
    loaded = load(lake, raw_frame, MIDNIGHT, [raw_row(MIDNIGHT, period="soon")])
    assert (loaded.rows, loaded.affected_dates) == (1, [])
    assert lake["stg_grid_metrics"].count() == 0
    assert jobs.score_anomalies(lake, loaded.affected_dates, "r") == 0


def test_failed_check_stops_the_run_and_is_recorded(lake, raw_frame):
    rows = window_rows(MIDNIGHT) + window_rows(MIDNIGHT)
    with pytest.raises(quality.CheckFailure, match="unique"):
        run(lake, raw_frame, MIDNIGHT, rows)
    metrics = lake["run_metrics"].first()
    assert (metrics["status"], metrics["rows_loaded"]) == ("failed", 6)
    assert (metrics["dbt_models_passed"], metrics["dbt_tests_passed"]) == (0, 0)
    assert lake["pipeline_state"].count() == 0
    assert lake["anomaly_results"].count() == 0
    assert lake["freshness_log"].count() == 1


def test_stale_source_stops_the_run_and_an_ageing_one_does_not(lake, raw_frame):
    frame = raw_frame(window_rows(MIDNIGHT))
    with pytest.raises(quality.CheckFailure, match="stale"):
        jobs.run_window(lake, frame, MIDNIGHT, "a", checked_at=MIDNIGHT.end + timedelta(hours=13))
    jobs.run_window(lake, frame, MIDNIGHT, "b", checked_at=MIDNIGHT.end + timedelta(hours=7))
    assert rows_of(lake["run_metrics"], "run_id", "status") == [("a", "failed"), ("b", "success")]


def test_missing_required_value_stops_the_load(lake, raw_frame):
    with pytest.raises(Exception, match="missing required columns: respondent"):
        run(lake, raw_frame, MIDNIGHT, [raw_row(MIDNIGHT, respondent=None)])
    assert rows_of(lake["run_metrics"], "status") == [("failed",)]


def test_failing_scores_only_warn(lake, raw_frame, monkeypatch):
    def broken(*_):
        raise RuntimeError("no scores")

    monkeypatch.setattr(jobs.anomalies, "score", broken)
    run(lake, raw_frame, MIDNIGHT)
    assert lake["run_metrics"].first()["status"] == "success"


def test_unreadable_signals_are_logged_as_unknown(lake, monkeypatch):
    def broken(*_):
        raise RuntimeError("no signals")

    monkeypatch.setattr(jobs.control, "freshness_signals", broken)
    jobs.log_freshness(lake, "r")
    row = lake["freshness_log"].first()
    assert (row["pipeline_freshness_status"], row["data_freshness_timestamp"]) == ("unknown", None)


def test_backfill_runs_each_window_and_again(lake, raw_frame):
    windows = [ELEVEN, MIDNIGHT, ONE]
    batches = [(w, raw_frame(window_rows(w, _ingestion_timestamp=w.end))) for w in windows]
    recent = utc("2025-11-14T03:00:00")
    for window, rows in batches:
        jobs.run_window(lake, rows, window, f"backfill__{window.batch_id}", checked_at=recent)
    assert lake["run_metrics"].where("status = 'success'").count() == 3
    assert rows_of(lake["agg_load_daily"], "observation_date", "total_load") == [
        (date(2025, 11, 13), 100.0),
        (D, 200.0),
    ]
    hourly = snapshot_of(lake)
    bulk = Lake(lake.spark, f"{lake.root}-bulk")
    everything = raw_frame([row for w in windows for row in window_rows(w)])
    jobs.bulk_backfill(bulk, everything, windows, checked_at=recent)
    assert snapshot_of(bulk) == hourly
    records = rows_of(bulk["run_metrics"], "window_end", "rows_loaded", "status")
    assert records == [(w.end.replace(tzinfo=None), 3, "success") for w in windows]
    assert bulk["freshness_log"].count() == 1 and bulk["pipeline_state"].count() == 1


def test_watermark_holds_one_row(lake):
    jobs.advance_state(lake, MIDNIGHT, "first", utc("2025-11-14T01:10:00"))
    jobs.advance_state(lake, ONE, "second", utc("2025-11-14T02:10:00"))
    assert rows_of(lake["pipeline_state"], "pipeline_name", "last_successful_run_id") == [
        ("eia_grid_batch", "second")
    ]
    assert serving.latest_run_state(lake).first()["last_successful_run_id"] == "second"


def test_dimensions_update_and_insert_but_never_delete(lake, raw_frame):
    load(lake, raw_frame, MIDNIGHT)
    renamed = window_rows(ONE, respondent_name="NRTH renamed")
    other = [raw_row(ONE, respondent="ERCO", respondent_name="ERCOT")]
    load(lake, raw_frame, ONE, renamed + other)
    assert rows_of(lake["dim_region"]) == [("ERCO", "ERCOT"), ("NRTH", "NRTH renamed")]
    lake.merge("dim_region", lake.stored("dim_region").limit(0), ["region"])
    assert lake["dim_region"].count() == 2


def test_a_merge_cut_short_is_read_and_finished(lake, spark):
    import shutil

    names = [("A", "Alpha", ONE.start, ONE.start), ("B", "Beta", ONE.start, ONE.start)]
    first = spark.createDataFrame(names, TABLES["dim_region"].stored)
    lake.merge("dim_region", first, ["region"])
    # As if the driver had died after dropping the table and before moving the merge.
    path = lake.path("dim_region")
    shutil.move(path, f"{path}__merged")
    assert lake["dim_region"].count() == 2
    lake.merge("dim_region", first.limit(0), ["region"])
    assert rows_of(lake["dim_region"]) == [("A", "Alpha"), ("B", "Beta")]


def test_older_ingestion_does_not_win_back_a_name(lake, raw_frame):
    run(lake, raw_frame, ONE, window_rows(ONE, respondent_name="New"))
    run(lake, raw_frame, MIDNIGHT, window_rows(MIDNIGHT, respondent_name="Old"))
    assert rows_of(lake["dim_region"]) == [("NRTH", "New")]


def test_sample_tables_live_apart(spark, tmp_path, raw_frame):
    live, sample = Lake(spark, str(tmp_path)), Lake(spark, str(tmp_path), sample=True)
    jobs.load_raw(sample, raw_frame(window_rows(MIDNIGHT)), [MIDNIGHT])
    assert (live["eia_grid_batch"].count(), sample["eia_grid_batch"].count()) == (0, 3)
    assert "/raw_sample/" in sample.path("eia_grid_batch")
    assert "/checks/" in Lake(spark, "/x", datasets={"meta": "checks"}).path("run_metrics")


def test_schema_drift_is_refused(lake, spark):
    frame = spark.createDataFrame([("NRTH", 1)], "region string, region_name int")
    with pytest.raises(SchemaDrift):
        lake.replace("dim_region", frame)
    with pytest.raises(SchemaDrift):
        lake.append("dim_region", frame.withColumn("extra", F.lit(1)))


def test_control_tables_are_created_once(lake):
    lake.create_missing()
    jobs.advance_state(lake, ONE, "r")
    lake.create_missing()
    assert lake["pipeline_state"].count() == 1
    assert lake["run_metrics"].schema.fieldNames()[0] == "run_id"


def test_batch_copy_and_column_update(lake, raw_frame, spark, tmp_path):
    jobs.load_raw(lake, raw_frame(window_rows(ELEVEN) + window_rows(ONE)), [ELEVEN, ONE])
    copy = Lake(spark, str(tmp_path / "copy"))
    lake.copy_batch(copy, D)
    assert rows_of(copy["eia_grid_batch"].select("_batch_id").distinct()) == [(ONE.batch_id,)]
    stamp = utc("2025-11-07T00:00:00")
    batch = F.col("batch_date") == F.lit(D)
    copy.set_column("eia_grid_batch", batch, "_ingestion_timestamp", F.lit(stamp))
    status = quality.source_freshness(copy["eia_grid_batch"], stamp + timedelta(hours=7)).first()
    assert status["status"] == "warn"
    assert copy["eia_grid_batch"].count() == 3


def test_column_update_keeps_rows_it_does_not_pick(lake, raw_frame):
    rows = window_rows(ONE) + [raw_row(ONE, respondent="A", respondent_name="Other")]
    jobs.load_raw(lake, raw_frame(rows), [ONE])
    lake.set_column("eia_grid_batch", F.col("respondent") == "A", "_source_url", F.lit("new"))
    found = rows_of(lake["eia_grid_batch"], "respondent", "_source_url")
    assert [url for name, url in found if name == "A"] == ["new"]
    assert len(found) == 4 and all(url != "new" for name, url in found if name != "A")
    with pytest.raises(ValueError, match="by partition"):
        lake.set_column("eia_grid_batch", F.lit(True), "batch_date", F.lit(D))


def test_rows_of_undeclared_windows_fail_the_load(lake, raw_frame):
    with pytest.raises(Exception, match="undeclared window"):
        jobs.load_raw(lake, raw_frame(window_rows(ELEVEN) + window_rows(ONE)), [ONE])
    assert lake["eia_grid_batch"].count() == 0


def test_newest_name_wins_in_any_order_of_loads(lake, raw_frame):
    load(lake, raw_frame, ONE, window_rows(ONE, respondent_name="Newest"))
    load(lake, raw_frame, MIDNIGHT, window_rows(MIDNIGHT, respondent_name="Middle"))
    assert rows_of(lake["dim_region"], "region_name") == [("Newest",)]


def test_bound_query_over_the_tables(lake, raw_frame):
    load(lake, raw_frame, MIDNIGHT)
    found = lake.sql(
        "select region, total_load from agg_load_daily where observation_date = :day", day=D
    )
    assert rows_of(found) == [("NRTH", 100.0)]


def test_snapshot_differences(spark):
    before = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    after = spark.createDataFrame([(1,), (2,), (3,)], "a int")
    assert rows_of(snapshots.differences(before, after)) == [(1, "before"), (3, "after")]


def test_pages_to_marts(lake, tmp_path):
    import json

    row = {
        "period": "2025-11-14T00", "respondent": "NRTH", "respondent-name": "Northern Grid",
        "type-name": "Demand", "value": "871.25", "value-units": "megawatthours",
    }
    for name, extra in {"region": {"type": "D"}, "fuel": {"fueltype": "NG"}}.items():
        (tmp_path / name).mkdir()
        page = {"response": {"total": "1", "data": [row | extra]}}
        (tmp_path / name / "page.json").write_text(json.dumps(page))
    rows = read_families(lake.spark, str(tmp_path / "region"), str(tmp_path / "fuel"))
    landing = str(tmp_path / "landing")
    landed = jobs.land_window(lake, landing, MIDNIGHT, rows, MIDNIGHT.end)
    jobs.run_window(lake, landed, MIDNIGHT, "r", checked_at=MIDNIGHT.end)
    assert rows_of(lake["agg_load_daily"], "total_load") == [(871.25,)]
    assert rows_of(lake["agg_generation_mix"], "daily_total_generation") == [(871.25,)]


def test_arriving_windows_are_loaded_once_and_reloaded_when_relanded(lake, raw_frame, tmp_path):
    from wattlane.sources.landing import land

    landing, progress = str(tmp_path / "landing"), str(tmp_path / "progress")
    land(raw_frame(window_rows(MIDNIGHT)), landing)
    checked = {"checked_at": ONE.end}
    load_arriving(lake, landing, progress, **checked).awaitTermination()
    assert rows_of(lake["agg_load_daily"], "total_load") == [(100.0,)]
    land(raw_frame(window_rows(ONE)), landing)
    land(raw_frame(window_rows(MIDNIGHT, 50.0)), landing)
    load_arriving(lake, landing, progress, **checked).awaitTermination()
    assert rows_of(lake["agg_load_daily"], "total_load") == [(150.0,)]
    load_arriving(lake, landing, progress, **checked).awaitTermination()
    assert lake["eia_grid_batch"].count() == 6


