"""The partition book against the tables as they lie."""

from __future__ import annotations

import shutil
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import generation_row, raw_row, rows_of, utc, window
from wattlane import Lake
from wattlane.book import BOOKED, measured
from wattlane.lake import day_leaves, union_all
from wattlane.operators import control, quality
from wattlane.plans import jobs, serving
from wattlane.schemas import PARTITION_BOOK, RAW

FIRST, SECOND = window("2025-11-14T22:00:00"), window("2025-11-15T01:00:00")
DAYS = [date(2025, 11, 14), date(2025, 11, 15)]


def rows(batch, *periods, **changes):
    made = [raw_row(batch, period=p, **changes) for p in periods]
    return made + [generation_row(batch, "NG", 5.0, period=p, **changes) for p in periods]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    given = rows(FIRST, "2025-11-14T22", "2025-11-15T00") + rows(SECOND, "2025-11-15T01")
    lake = Lake(spark, str(tmp_path_factory.mktemp("built") / "lake"))
    jobs.load_and_rebuild(lake, frame_of(spark, given), [FIRST, SECOND])
    jobs.score_anomalies(lake, DAYS, "run1", utc("2025-11-15T03:00:00"))
    return lake


@pytest.fixture
def loaded(built, tmp_path):
    """A lake of its own for each test, copied from one that was built once."""
    root = tmp_path / "loaded"
    shutil.copytree(built.root, root)
    return Lake(built.spark, str(root))


def frame_of(spark, given):
    schema = RAW.__class__([f.__class__(f.name, f.dataType, True) for f in RAW.fields])
    return spark.createDataFrame([tuple(r[n] for n in RAW.fieldNames()) for r in given], schema)


COLUMNS = [name for name in PARTITION_BOOK.fieldNames() if name != "entry"]


def assert_right(lake):
    """What the book says of every table is what a scan finds."""
    found = union_all(lake.book.partitions(name) for name in BOOKED)
    scanned = union_all(measured(lake, name, None) for name in BOOKED)
    assert rows_of(found, *COLUMNS) == rows_of(scanned, *COLUMNS)


def opened(frame):
    """The tables whose files a plan reads."""
    return {file.rsplit("/meta/", 1)[-1].split("/")[0] if "/meta/" in file else file for file in frame.inputFiles()}


def test_entries_equal_a_scan(loaded):
    assert_right(loaded)
    assert loaded.book.pending("agg_load_daily").nothing


def test_questions_open_no_data_file(loaded):
    jobs.log_freshness(loaded, "run1", utc("2025-11-15T03:00:00"))
    for asked in (
        serving.date_bounds(loaded),
        serving.anomaly_summary(loaded),
        jobs.newest_ingestions(loaded),
        control.freshness_signals(jobs.newest_ingestions(loaded), jobs.newest_observations(loaded)),
        quality.source_freshness(jobs.newest_ingestions(loaded), utc("2025-11-15T03:00:00")),
    ):
        assert opened(asked) == {"partition_book"}
    assert len(loaded.newest("freshness_log").inputFiles()) == 1


def test_answers_equal_those_of_plain_frames(loaded):
    plain = {n: loaded[n] for n in ("agg_load_daily", "agg_load_hourly", "agg_generation_mix", "agg_top_regions", "anomaly_results")}
    assert rows_of(serving.date_bounds(loaded)) == rows_of(serving.date_bounds(plain))
    assert rows_of(serving.anomaly_summary(loaded)) == rows_of(serving.anomaly_summary(plain))


def test_empty_lake_and_dict(lake, spark):
    lake.create_missing()
    assert rows_of(serving.date_bounds(lake)) == [(None, None)]
    assert rows_of(serving.anomaly_summary(lake)) == [(None, None, 0, 0)]
    plain = {"anomaly_results": lake["anomaly_results"]}
    assert rows_of(serving.anomaly_summary(plain)) == [(None, None, 0, 0)]


def test_days_of_a_batch_and_their_folders(loaded):
    found = loaded.book.raw_leaves([DAYS[1]])
    assert found["_batch_id"] == {FIRST.batch_id, SECOND.batch_id}
    assert found["batch_date"] == {"2025-11-14", "2025-11-15"}
    assert loaded.book.raw_leaves([DAYS[0]])["_batch_id"] == {FIRST.batch_id}
    assert loaded.book.raw_leaves([date(2025, 11, 20)])["_batch_id"] == set()
    assert loaded.stored("eia_grid_batch", loaded.book.raw_leaves([DAYS[0]])).count() == 2


def test_reloads_drop_days_and_rows(loaded, raw_frame):
    jobs.load_and_rebuild(loaded, raw_frame(rows(FIRST, "2025-11-14T22")), [FIRST])
    assert_right(loaded)
    jobs.load_and_rebuild(loaded, raw_frame(rows(FIRST, "2025-11-15T00")), [FIRST])
    assert_right(loaded)
    assert rows_of(serving.date_bounds(loaded)) == [(DAYS[1], DAYS[1])]
    jobs.load_and_rebuild(loaded, raw_frame([]), [FIRST, SECOND])
    assert_right(loaded)
    assert rows_of(serving.date_bounds(loaded)) == [(None, None)]


def test_a_day_that_a_load_replaces_as_a_whole(loaded, raw_frame):
    third = window("2025-11-15T05:00:00")
    jobs.load_raw(loaded, raw_frame(rows(third, "2025-11-15T05")), [third], replace=jobs.REPLACE_DAY)
    found = rows_of(loaded.book.partitions("eia_grid_batch"), "_batch_id", "observation_date", "n_rows")
    assert found == [(FIRST.batch_id, DAYS[0], 2), (FIRST.batch_id, DAYS[1], 2), (third.batch_id, DAYS[1], 2)]


def test_a_job_that_stops_half_way_is_read_as_it_lies(loaded, raw_frame, monkeypatch):
    with monkeypatch.context() as stop:
        stop.setattr(jobs, "_build_marts", lambda *_: (_ for _ in ()).throw(InterruptedError()))
        with pytest.raises(InterruptedError):
            jobs.load_and_rebuild(loaded, raw_frame(rows(SECOND, "2025-11-15T01", "2025-11-16T00")), [SECOND])
    state = loaded.book.pending("stg_grid_metrics")
    assert state.leaves == day_leaves([DAYS[1], date(2025, 11, 16)])
    assert_right(loaded)
    jobs.rebuild(loaded, [DAYS[1], date(2025, 11, 16)])
    assert loaded.book.pending("stg_grid_metrics").nothing
    assert_right(loaded)


def test_a_load_that_stops_is_read_as_it_lies(loaded, raw_frame, monkeypatch):
    with monkeypatch.context() as stop:
        stop.setattr(Lake, "files", lambda *_: (_ for _ in ()).throw(InterruptedError()))
        with pytest.raises(InterruptedError):
            jobs.load_raw(loaded, raw_frame(rows(SECOND, "2025-11-16T00")), [SECOND])
    assert loaded.book.pending("eia_grid_batch").leaves["_batch_id"] == {SECOND.batch_id}
    assert loaded.book.raw_leaves([DAYS[1]])["_batch_id"] == {FIRST.batch_id, SECOND.batch_id}
    assert_right(loaded)


def test_writes_outside_a_job_are_noticed(loaded):
    day = day_leaves([DAYS[1]])
    none = loaded.spark.createDataFrame([], loaded["agg_load_daily"].schema)
    loaded.replace_partitions("agg_load_daily", none, day)
    assert loaded.book.pending("agg_load_daily").leaves == day
    assert_right(loaded)
    loaded.replace("agg_top_regions", loaded.spark.createDataFrame([], loaded["agg_top_regions"].schema))
    assert loaded.book.pending("agg_top_regions").whole
    assert_right(loaded)
    jobs.rebuild(loaded)
    assert_right(loaded)
    assert all(loaded.book.pending(name).nothing for name in BOOKED)


def test_an_updated_column_is_entered(loaded):
    stamp = utc("2025-11-20T00:00:00")
    batch = F.col("_batch_id") == SECOND.batch_id
    loaded.set_column("eia_grid_batch", batch, "_ingestion_timestamp", F.lit(stamp))
    assert loaded.book.pending("eia_grid_batch").nothing
    assert_right(loaded)
    newest = jobs.newest_ingestions(loaded).agg(F.max("_ingestion_timestamp")).first()[0]
    assert newest.replace(tzinfo=None) == stamp.replace(tzinfo=None)


def test_scores_of_reruns_are_counted(loaded):
    for n in range(2, 4):
        jobs.score_anomalies(loaded, DAYS, f"run{n}", utc(f"2025-11-15T0{n + 2}:00:00"))
        assert_right(loaded)
    summary = serving.anomaly_summary(loaded).first()
    assert summary["latest_anomaly_checked_at"].replace(tzinfo=None) == utc("2025-11-15T05:00:00").replace(tzinfo=None)


def test_a_lake_that_had_no_book(loaded, raw_frame, tmp_path):
    """As one that an earlier version wrote: asked as it lies, entered by what is done to it."""
    folder, files = loaded._folder(loaded.path("partition_book"))
    files.delete(folder, True)
    again = Lake(loaded.spark, loaded.root)
    assert again.book.pending("agg_load_daily").whole
    assert_right(again)
    third = window("2025-11-16T05:00:00")
    jobs.load_raw(again, raw_frame(rows(third, "2025-11-16T05")), [third])
    assert again.book.pending("stg_grid_metrics").whole
    assert_right(again)
    again.book.renew()
    assert all(again.book.pending(name).nothing for name in BOOKED)
    assert_right(again)


def test_many_changes_are_merged(loaded, raw_frame):
    for n in range(6):
        period = (utc("2025-11-15T02:00:00") + timedelta(hours=n)).strftime("%Y-%m-%dT%H")
        jobs.load_raw(loaded, raw_frame(rows(SECOND, period)), [SECOND])
    assert len(loaded.segments("partition_book").segments()) < 12
    assert_right(loaded)
