"""Plan shapes: what must hold when the tables are large."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import generation_row, raw_row
from wattlane.functions.periods import in_dates
from wattlane.operators import anomalies, latency, marts, quality, staging
from wattlane.plans import jobs, serving
from wattlane.window import BatchWindow

WINDOW = BatchWindow.of("2025-11-14T00:00:00", "2025-11-15T00:00:00")
D = date(2025, 11, 14)
AGGREGATES = ("load_daily", "load_hourly", "generation_mix", "top_regions")


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    from wattlane import Lake
    from wattlane.schemas import RAW

    lake = Lake(spark, str(tmp_path_factory.mktemp("plans")))
    rows = [raw_row(WINDOW), generation_row(WINDOW, "NG", 5.0)]
    values = [tuple(row[name] for name in RAW.fieldNames()) for row in rows]
    jobs.load_and_rebuild(lake, spark.createDataFrame(values, RAW), [WINDOW])
    jobs.score_anomalies(lake, [D], "r", WINDOW.end)
    return lake


def test_reads_prune_partitions_and_push_filters(filled):
    plan = plan_of(serving.load_metrics(filled, "NRTH", D, D))
    assert "PartitionFilters: [isnotnull(observation_date" in plan
    assert "EqualTo(region,NRTH)" in plan
    plan = plan_of(serving.top_regions(filled, D, D, 5))
    assert "LessThanOrEqual(rank,5)" in plan
    days = in_dates(F.col("observation_date"), [D])
    assert "PartitionFilters: [isnotnull(observation_date" in plan_of(
        filled["fct_grid_metrics"].where(days)
    )


def test_fact_scans_read_only_their_columns(filled):
    plan = plan_of(marts.generation_mix(filled["fct_grid_metrics"]))
    assert "metric_surrogate_key" not in plan
    assert "EqualTo(metric_name,generation)" in plan
    plain = {f"agg_{name}": filled[f"agg_{name}"] for name in AGGREGATES}
    assert plan_of(serving.date_bounds(plain)).count("ReadSchema: struct<>") == 4


def test_bounds_of_a_lake_read_its_book_alone(filled):
    files = serving.date_bounds(filled).inputFiles()
    assert files and all("/partition_book/" in file for file in files)


@pytest.mark.parametrize("build", [marts.load_daily, marts.generation_mix, marts.dim_region])
def test_the_pass_over_the_fact_hashes_without_sorting(filled, build):
    lines = plan_of(build(filled["fct_grid_metrics"])).splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
    first = next(line for line in reversed(lines[:scan]) if "Aggregate" in line)
    assert "HashAggregate" in first and "partial_" in first


def test_baseline_needs_no_join(filled):
    metrics = anomalies.daily_metrics(filled["agg_load_daily"], filled["agg_generation_mix"])
    plan = plan_of(anomalies.score(metrics, [D]))
    assert "Join" not in plan
    assert plan.count("hashpartitioning(region") == 1


def test_inline_ranking_limits_each_day_before_the_shuffle(filled):
    ranked = marts.top_regions(filled["agg_load_daily"]).where("rank <= 3")
    assert "WindowGroupLimit" in plan_of(ranked)


def test_newest_batch_gathers_no_grain_in_a_window(filled):
    plan = plan_of(staging.newest_batch(filled["stg_grid_metrics"]))
    assert "Window" not in plan
    assert "partial_max(_ingestion_timestamp" in plan


def test_no_query_uses_a_cartesian_product(filled):
    frames = [
        serving.anomaly_summary(filled),
        serving.response_metadata(filled),
        serving.data_quality_status(filled),
        serving.anomalies(filled, latest_only=True),
        quality.check_results(filled),
        latency.latency_summary(
            filled["stg_grid_metrics"].withColumnRenamed("metric_value", "v"), ["region"], "v"
        ),
    ]
    for frame in frames:
        plan = plan_of(frame)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_percentiles_keep_no_group_in_one_buffer(filled):
    rows = filled["stg_grid_metrics"]
    plan = plan_of(latency.latency_summary(rows, ["region"], "metric_value"))
    assert "ObjectHashAggregate" not in plan and "collect" not in plan


def test_writes_rebalance_by_day_but_a_laid_out_copy_is_not_shuffled(filled):
    rows = filled["stg_grid_metrics"]
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(filled._writer("stg_grid_metrics", rows)._df)
    assert "Exchange" not in plan_of(filled._writer("fct_grid_metrics", rows, True)._df)


def test_usual_labels_are_spelt_when_the_query_is_planned(filled):
    plan = plan_of(staging.canonicalise(filled["eia_grid_batch"]))
    assert "THEN net_generation" in plan and "THEN total_interchange" in plan
