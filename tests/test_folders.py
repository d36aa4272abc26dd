"""Tables of many small day folders, and the lakes that queries build of them."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from catalog import lakes
from catalog.queries import bound_sql
from wattlane.plans import jobs
from wattlane.schemas import TABLES
from wattlane.session import COALESCED, LISTING, prepare_folders


def _days(spark, n_days: int, n_regions: int):
    rows = spark.range(n_days * n_regions).select(
        F.concat(F.lit("R"), F.col("id") % n_regions).alias("region"),
        F.lit("name").alias("region_name"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") / n_regions).cast("int")).alias(
            "observation_date"
        ),
        *[F.rand(7).alias(c) for c in ("avg_load", "min_load", "max_load", "total_load")],
        F.lit("MWh").alias("unit"),
    )
    return rows.select(*TABLES["agg_load_daily"].schema.fieldNames())


def test_days_of_a_small_table_are_written_by_several_tasks(spark, lake):
    rows = _days(spark, 30, 300)
    assert lake.replace_partitions("agg_load_daily", rows) == []
    files = lake["agg_load_daily"].inputFiles()
    assert len({re.search(r"part-(\d+)", file)[1] for file in files}) > 1
    assert lake["agg_load_daily"].count() == 9000


def test_folders_are_listed_by_the_core_and_own_settings_stay(spark, lake):
    assert int(spark.conf.get(LISTING)) == 4 * spark.sparkContext.defaultParallelism
    own = spark.newSession()
    own.conf.set(LISTING, "7")
    prepare_folders(own)
    assert own.conf.get(LISTING) == "7"
    assert own.conf.get(COALESCED) == "16k"


def test_a_first_write_is_replaced_by_the_next(spark, lake):
    days = [date(2024, 1, 1) + timedelta(days=n) for n in range(3)]
    leaves = {"observation_date": {day.isoformat() for day in days}}
    lake.replace_partitions("agg_load_daily", _days(spark, 3, 2), leaves)
    stale = lake.replace_partitions("agg_load_daily", _days(spark, 2, 5), leaves)
    assert [leaf.rsplit("=", 1)[1] for leaf in stale] == ["2024-01-03"]
    counts = lake["agg_load_daily"].groupBy("observation_date").count().collect()
    assert sorted(map(tuple, counts)) == [(days[0], 5), (days[1], 5)]


@pytest.fixture
def given(spark, tmp_path):
    start = datetime(2024, 1, 1)
    events = [
        (n, start + timedelta(hours=7 * n), n % 5, "error", float(n), "{}") for n in range(40)
    ]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(events, schema).write.parquet(str(tmp_path / "events.parquet"))
    nations = [(n, f"nation {n}") for n in range(5)]
    spark.createDataFrame(nations, "n_nationkey int, n_name string").write.parquet(
        str(tmp_path / "nation.parquet")
    )
    return str(tmp_path)


def test_a_query_of_data_tables_waits_for_no_checks_or_scores(spark, given, monkeypatch):
    def never(*_args, **_named):
        raise AssertionError("only the data tables are read")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "run_checks", never)
        patch.setattr(jobs, "score_anomalies", never)
        found = sorted(map(tuple, bound_sql(spark, given).collect()))
        expected = lakes.views(spark, given)["agg_top_regions"].where("rank <= 3")
        assert found == sorted(map(tuple, expected.collect()))
    assert found
    # The same lake is the one that is then checked and scored.
    lake = lakes.built_lake(spark, given)
    assert lake is lakes.loaded_lake(spark, given)
    assert lake["run_metrics"].count() == 2
    assert lake["anomaly_results"].count() > 0
