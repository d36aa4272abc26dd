"""Read queries over the marts and control tables.

``tables`` maps table names to DataFrames: a ``Lake`` or a plain dict. Every query
returns a DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlane.functions.arguments import (
    InvalidRequest,
    check_budget,
    check_dates,
    check_granularity,
    check_limit,
    check_region,
    closed_days,
)
from wattlane.functions.metrics import trimmed
from wattlane.functions.scoring import share_pct
from wattlane.functions.status import combined_status, known_status
from wattlane.book import measures
from wattlane.lake import Lake, union_all
from wattlane.operators.anomalies import latest_scores
from wattlane.schemas import TABLES

Tables = Mapping[str, DataFrame]

DAY = "observation_date"


def _in_range(rows: DataFrame, start: date | None, end: date | None) -> DataFrame:
    if start is not None:
        rows = rows.where(F.col(DAY) >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col(DAY) <= F.lit(end))
    return rows


# Load


def load_metrics(
    tables: Tables, region: str, start: date, end: date, granularity: str = "daily"
) -> DataFrame:
    """One region's load, hourly or daily, in time order."""
    check_region(region)
    check_dates(start, end)
    check_granularity(granularity)
    rows = tables[f"agg_load_{granularity}"].where(F.col("region") == region)
    order = "observation_timestamp" if granularity == "hourly" else "observation_date"
    return _in_range(rows, start, end).orderBy(order)


def load_summary(rows: DataFrame) -> DataFrame:
    """Extremes and the earliest peak of a load result; no row when it is empty."""
    hourly = "hourly_load" in rows.columns
    load, when, names = (
        ("hourly_load", "observation_timestamp", ("min_load", "max_load", "peak_timestamp"))
        if hourly
        else ("total_load", "observation_date", ("min_total_load", "max_total_load", "peak_date"))
    )
    day_number = F.unix_micros(F.col(when)) if hourly else F.unix_date(F.col(when))
    peak = F.max_by(F.col(when), F.struct(F.col(load), -day_number))
    return (
        rows.agg(
            F.count(F.lit(1)).alias("n"),
            F.min(load).alias(names[0]),
            F.max(load).alias(names[1]),
            peak.alias(names[2]),
        )
        .where(F.col("n") > 0)
        .drop("n")
    )


# Generation


def generation_mix(
    tables: Tables, region: str, start: date, end: date, *, shares: bool = False
) -> DataFrame:
    """One region's generation by day and source, optionally with its share of the day."""
    check_region(region)
    check_dates(start, end)
    rows = tables["agg_generation_mix"].where(F.col("region") == region)
    rows = _in_range(rows, start, end)
    if shares:
        rows = with_shares(rows)
    return rows.orderBy("observation_date", "energy_source")


def with_shares(mix: DataFrame) -> DataFrame:
    """Share within each region and day; a window holds one day's sources."""
    day = Window.partitionBy("region", "observation_date")
    total = F.sum("daily_total_generation").over(day)
    return mix.withColumn(
        "generation_share_pct", share_pct(F.col("daily_total_generation"), total)
    )


def dominant_source(mix: DataFrame) -> DataFrame:
    """The source with the largest total; ties go to the one listed first."""
    return (
        mix.groupBy("energy_source")
        .agg(
            F.sum("daily_total_generation").alias("total_generation"),
            F.min("observation_date").alias("first_date"),
        )
        .orderBy(F.col("total_generation").desc(), "first_date", "energy_source")
        .limit(1)
        .select("energy_source", "total_generation")
    )


# Ranking


def top_regions(tables: Tables, start: date, end: date, limit: int = 10) -> DataFrame:
    """The regions ranked ``limit`` or better on each day, from the stored ranks."""
    check_dates(start, end)
    check_limit(limit)
    rows = _in_range(tables["agg_top_regions"], start, end)
    return rows.where(F.col("rank") <= limit).orderBy("observation_date", "rank")


# Control tables


def _latest(tables: Tables, name: str, by: str) -> DataFrame:
    """The newest row of a log; a lake reads the one segment that has it."""
    kept = isinstance(tables, Lake) and TABLES[name].segmented
    rows = tables.newest(name) if kept else tables[name]
    return rows.orderBy(F.col(by).desc()).limit(1)


def _partitions(tables: Tables, name: str) -> DataFrame:
    """What is known of each day of a table: a lake's book has it, else the rows are asked."""
    if isinstance(tables, Lake):
        return tables.book.partitions(name)
    columns = [value.alias(column) for column, value in measures(name).items()]
    return tables[name].groupBy(DAY).agg(*columns)


def _one_row(rows: DataFrame, *columns: Column) -> DataFrame:
    """At most one row in, exactly one out: NULLs where there was none."""
    kept = rows.agg(*[F.max(name).alias(name) for name in rows.columns])
    return kept.select(*columns) if columns else kept


def latest_freshness(tables: Tables) -> DataFrame:
    """Both signals of the newest check and the worse of the two; unknown when none ran."""
    latest = _latest(tables, "freshness_log", "checked_at")
    pipeline, data = F.col("pipeline_freshness_status"), F.col("data_freshness_status")
    return _one_row(
        latest,
        F.col("pipeline_freshness_timestamp"),
        F.col("data_freshness_timestamp"),
        known_status(pipeline).alias("pipeline_freshness_status"),
        known_status(data).alias("data_freshness_status"),
        combined_status(pipeline, data).alias("freshness_status"),
        F.col("checked_at"),
    )


def latest_run_state(tables: Tables) -> DataFrame:
    """The newest successful window; NULLs when none is recorded."""
    return _one_row(_latest(tables, "pipeline_state", "updated_at"))


def response_metadata(tables: Tables) -> DataFrame:
    """Data time, run and combined freshness; either source may be missing."""
    freshness = latest_freshness(tables).select(
        F.col("data_freshness_timestamp").alias("data_as_of"), "freshness_status"
    )
    state = latest_run_state(tables).select(
        F.col("last_successful_run_id").alias("pipeline_run_id")
    )
    return _side_by_side(freshness, state).select(
        "data_as_of", "pipeline_run_id", "freshness_status"
    )


def _side_by_side(*one_row_frames: DataFrame) -> DataFrame:
    """One-row frames with distinct columns as one row, without a join."""
    stacked = one_row_frames[0]
    for frame in one_row_frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


# Anomalies

ANOMALY_COLUMNS = (
    "observation_date",
    "region",
    "metric_name",
    "current_value",
    "rolling_7d_avg",
    "pct_deviation",
    "anomaly_flag",
    "checked_at",
)


def anomalies(
    tables: Tables,
    region: str | None = None,
    start: date | None = None,
    end: date | None = None,
    *,
    flagged_only: bool = True,
    latest_only: bool = False,
) -> DataFrame:
    """Scored rows, newest day first. Reruns repeat rows unless ``latest_only`` is set."""
    check_dates(start, end)
    rows = _in_range(tables["anomaly_results"], start, end)
    if region is not None:
        rows = rows.where(F.col("region") == region)
    if latest_only:
        rows = latest_scores(rows)
    if flagged_only:
        rows = rows.where(F.col("anomaly_flag"))
    return rows.select(*ANOMALY_COLUMNS).orderBy(
        F.col("observation_date").desc(), F.col("checked_at").desc(), "region", "metric_name"
    )


def truncated(rows: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """The first rows of an ordered result and whether any were cut off."""
    over = rows.limit(max_rows + 1).count() > max_rows
    return rows.limit(max_rows), over


def flagged_count(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count_if("anomaly_flag").alias("flagged_rows"), F.count(F.lit(1)).alias("returned_rows")
    )


def anomaly_summary(tables: Tables) -> DataFrame:
    """Flags and regions of the seven days up to the newest scored day; a zero row if none.

    Of a lake, its book tells them by day; the newest day is a scalar subquery.
    """
    days = _partitions(tables, "anomaly_results")
    latest = days.agg(F.max(DAY)).scalar()
    regions_flagged = F.array_distinct(F.flatten(F.collect_list("flagged_regions")))
    return days.where(F.col(DAY) >= F.date_sub(latest, 6)).agg(
        F.max(DAY).alias("latest_observation_date"),
        F.max("newest_check").alias("latest_anomaly_checked_at"),
        F.coalesce(F.sum("n_flagged"), F.lit(0)).alias("flagged_anomaly_count_last_7_days"),
        F.size(regions_flagged).cast("long").alias("affected_regions_last_7_days"),
    )


def data_quality_status(tables: Tables) -> DataFrame:
    """Freshness, run state and anomaly summary in one row."""
    return _side_by_side(
        latest_freshness(tables), latest_run_state(tables), anomaly_summary(tables)
    )


# Discovery


def date_bounds(tables: Tables) -> DataFrame:
    """First and last day over the four aggregates; a lake's book has them."""
    names = ("agg_load_daily", "agg_load_hourly", "agg_generation_mix", "agg_top_regions")
    bounds = [
        _partitions(tables, name).agg(F.min(DAY).alias("min_date"), F.max(DAY).alias("max_date"))
        for name in names
    ]
    return union_all(bounds).agg(
        F.min("min_date").alias("start_date"), F.max("max_date").alias("end_date")
    )


def regions(tables: Tables) -> DataFrame:
    return tables["dim_region"].orderBy("region")


def energy_sources(tables: Tables) -> DataFrame:
    return tables["dim_energy_source"].orderBy("energy_source")


def latest_parameters(aggregate: DataFrame) -> DataFrame:
    """The first region of the newest day, as sample arguments for the read queries."""
    return (
        aggregate.select("region", "observation_date")
        .orderBy(F.col("observation_date").desc(), "region")
        .limit(1)
    )


def match_regions(requests: DataFrame, dim_region: DataFrame) -> DataFrame:
    """Requested codes or names (column ``requested``) with their region, NULL if unknown.

    Case and outer blanks are ignored; a code match beats a name match.
    """
    codes = dim_region.select(
        F.lower("region").alias("asked"), F.lit(0).alias("by_name"), "region", "region_name"
    )
    names = dim_region.select(
        F.lower("region_name").alias("asked"), F.lit(1).alias("by_name"), "region", "region_name"
    )
    # Of several regions under one text, the last code wins within a kind.
    best = F.max_by(F.struct("region", "region_name"), F.struct(-F.col("by_name"), "region"))
    known = codes.unionByName(names).groupBy("asked").agg(best.alias("match"))
    asked = requests.withColumn("asked", F.lower(trimmed(F.col("requested"))))
    return asked.join(known, "asked", "left").select(
        *requests.columns, "match.region", "match.region_name"
    )


def resolve_region(tables: Tables, requested: str) -> tuple[str, str]:
    """Code and name of one requested region; an error with examples when unknown."""
    check_region(requested)
    dimension = tables["dim_region"]
    asked = F.lower(F.lit(requested.strip()))
    by_code = F.lower("region") == asked
    found = (
        dimension.where(by_code | (F.lower("region_name") == asked))
        .orderBy(by_code.desc(), F.col("region").desc())
        .take(1)
    )
    if not found:
        examples = [row["region"] for row in regions(tables).take(5)]
        raise InvalidRequest(
            f"no region has the code or name {requested!r}",
            hint=f"Some codes that are known: {', '.join(examples)}.",
        )
    return found[0]["region"], found[0]["region_name"]


# Bounded forms: region by code or name, and budgets that callers may set


def bounded_load(
    tables: Tables,
    region: str,
    start: date,
    end: date,
    granularity: str = "daily",
    *,
    max_rows: int | None = None,
    max_hourly_days: int | None = None,
) -> DataFrame:
    """Load of a region; refused where its range may hold more than the caller allows."""
    code, _ = resolve_region(tables, region)
    days = closed_days(start, end)
    check_granularity(granularity)
    hourly = granularity == "hourly"
    if hourly and max_hourly_days is not None and days > max_hourly_days:
        raise InvalidRequest(
            f"hourly values of {days} days, more than the {max_hourly_days} allowed",
            hint="Daily values, or a shorter range of days, will do.",
        )
    check_budget(days * (24 if hourly else 1), max_rows, "load")
    return load_metrics(tables, code, start, end, granularity)


def bounded_generation_mix(
    tables: Tables,
    region: str,
    start: date,
    end: date,
    *,
    shares: bool = True,
    max_rows: int | None = None,
) -> DataFrame:
    code, _ = resolve_region(tables, region)
    if max_rows is not None:
        sources = max(tables["dim_energy_source"].count(), 1)
        check_budget(closed_days(start, end) * sources, max_rows, "generation mix")
    return generation_mix(tables, code, start, end, shares=shares)


def bounded_top_regions(
    tables: Tables, start: date, end: date, limit: int = 10, *, max_rows: int | None = None
) -> DataFrame:
    check_limit(limit)
    check_budget(closed_days(start, end) * limit, max_rows, "top regions")
    return top_regions(tables, start, end, limit)


def bounded_anomalies(
    tables: Tables,
    region: str | None = None,
    start: date | None = None,
    end: date | None = None,
    *,
    flagged_only: bool = True,
    max_rows: int | None = None,
) -> tuple[DataFrame, bool]:
    """Anomaly rows, the first ``max_rows`` if it is given, and whether more exist."""
    code = resolve_region(tables, region)[0] if region is not None else None
    rows = anomalies(tables, code, start, end, flagged_only=flagged_only)
    return (rows, False) if max_rows is None else truncated(rows, max_rows)
