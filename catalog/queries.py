"""One registered query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.lakes import (
    batch_days,
    built_lake,
    check_times,
    fresh_lake,
    loaded_lake,
    raw_rows,
    staged_rows,
    table,
    views,
)
from catalog.oracle import (
    DAILY_COLUMNS,
    FRESHNESS_COLUMNS,
    HOURLY_COLUMNS,
    METRIC_COLUMNS,
    MIX_COLUMNS,
    RAW_COLUMNS,
    SCORE_COLUMNS,
    STATE_COLUMNS,
    SUMMARY_COLUMNS,
    TOP_COLUMNS,
)
from catalog.registry import register
from wattlane.book import BOOKED
from wattlane.functions import metrics, periods, scoring, status
from wattlane.lake import Lake, day_leaves, union_all
from wattlane.operators import (
    anomalies,
    control,
    deltas,
    ingest,
    latency,
    marts,
    quality,
    snapshots,
    staging,
)
from wattlane.operators.ranks import ranked_in_ranges
from wattlane.plans import jobs, serving
from wattlane.schemas import RAW
from wattlane.sources import landing, pages
from wattlane.sources.events import as_pages
from wattlane.streaming import staleness
from wattlane.streaming.windows import load_arriving
from wattlane.window import BatchWindow, daily_window

FIRST, LAST = date(2024, 1, 1), date(2024, 1, 31)
REGION, REGION_NAME = "R7", "NATION_7"
BETWEEN = "observation_date between date '2024-01-01' and date '2024-01-31'"
CHECKED = datetime(2024, 1, 20, tzinfo=UTC)

# The two check times of the built lake, from the last day of the data.
CHECKS_SQL = """
    (select 1 as run, cast(max(batch_date) as timestamp) + interval 27 hour as checked_at from raw
     union all
     select 2, cast(max(batch_date) as timestamp) + interval 1770 minute from raw)
"""


# Sources and sinks


_PAGES: dict[tuple[str, str], str] = {}


def _paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows written as page files of both families, once a session, and read back."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PAGES:
        folder = fresh_lake(spark, "pages").root
        as_pages(raw_rows(spark, sf_dir)).write.partitionBy("row_kind").json(folder)
        _PAGES[key] = folder
    folder = _PAGES[key]
    return pages.read_families(
        spark,
        f"{folder}/row_kind={pages.REGION_ROWS}",
        f"{folder}/row_kind={pages.FUEL_TYPE_ROWS}",
        multi_line=False,
    )


@register(
    "page_scan",
    "row_kind period respondent respondent_name type fueltype type_name f:value value_units",
    """select case when fueltype is null then 'region' else 'fuel_type' end as row_kind, period,
        respondent, respondent_name, case when fueltype is null then type end as type, fueltype,
        coalesce(fueltype_name, type_name) as type_name, value, value_units from raw""",
)
def page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _paged(spark, sf_dir).drop("__source_url")
    renamed = rows.withColumnsRenamed(
        {name: name.strip("_").replace("-", "_") for name in rows.columns}
    )
    return renamed.withColumn("value", F.col("value").cast("double"))


@register(
    "family_concat",
    "row_kind i:n_rows f:total i:n_sources",
    """select case when fueltype is null then 'region' else 'fuel_type' end as row_kind,
        count(*) as n_rows, sum(value) as total, 1 as n_sources from raw group by 1""",
)
def family_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = F.regexp_extract("__source_url", "row_kind=([a-z_]+)", 1)
    return _paged(spark, sf_dir).groupBy(F.col("__row_kind").alias("row_kind")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("value").cast("double")).alias("total"),
        F.countDistinct(folder).alias("n_sources"),
    )


@register(
    "normalised_rows",
    RAW_COLUMNS,
    """select * replace (date '2024-01-01' as batch_date,
        '20240101T000000_20240131T000000' as _batch_id,
        case when fueltype is null then 'region' else 'fuel_type' end as _source_url,
        timestamp '2024-01-31 01:05:00' as _ingestion_timestamp) from raw""",
)
def normalised_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = BatchWindow.of("2024-01-01", "2024-01-31")
    rows = ingest.require_rows(_paged(spark, sf_dir))
    stamped = ingest.stamp_batch(rows, window, datetime(2024, 1, 31, 1, 5, tzinfo=UTC))
    folder = F.regexp_extract("_source_url", "row_kind=([a-z_]+)", 1)
    return ingest.normalise(stamped).withColumn("_source_url", folder)


@register(
    "row_rejects",
    "outcome i:n_rows",
    """select outcome, count(*) as n_rows from (
        select case
            when k = 24 then 'row is missing the row kind marker'
            when k = 0 and hour(hour) = 0 then 'row is missing required fields: respondent, period'
            when k = 0 then 'row is missing required fields: respondent'
            when hour(hour) = 0 then 'row is missing required fields: period'
            when value > 100 then 'row value must be numeric' else 'accepted' end as outcome
        from hourly) group by 1""",
)
def row_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows broken on purpose by region, hour and size, split from the good ones."""
    rows = _paged(spark, sf_dir)
    broken = rows.withColumns(
        {
            "__row_kind": F.when(F.col("respondent") != "R24", F.col("__row_kind")),
            "respondent": F.when(F.col("respondent") != "R0", F.col("respondent")),
            "period": F.when(~F.col("period").endswith("T00"), F.col("period")).otherwise(""),
            "value": F.when(F.col("value").cast("double") > 100, "n/a").otherwise(F.col("value")),
        }
    )
    window = BatchWindow.of("2024-01-01", "2024-01-31")
    good, rejects = ingest.split_rejects(ingest.stamp_batch(broken, window, CHECKED))
    outcomes = rejects.select(F.col("violation").alias("outcome")).unionByName(
        good.select(F.lit("accepted").alias("outcome"))
    )
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_rows"))


@register("landed_rows", RAW_COLUMNS, "select * from raw")
def landed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_lake(spark, "landing").root
    landing.land(raw_rows(spark, sf_dir), folder)
    return landing.read_landed(spark, folder)


@register(
    "raw_table",
    RAW_COLUMNS,
    "select * from raw",
)
def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_lake(spark, sf_dir)["eia_grid_batch"]


@register(
    "raw_partitions",
    "d:batch_date _batch_id d:observation_date i:n_rows f:total",
    """select batch_date, _batch_id, cast(strptime(period, '%Y-%m-%dT%H') as date)
        as observation_date, count(*) as n_rows, sum(value) as total from raw group by 1, 2, 3""",
)
def raw_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = loaded_lake(spark, sf_dir).stored("eia_grid_batch")
    return stored.groupBy("batch_date", "_batch_id", "observation_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("total")
    )


@register("staged_table", METRIC_COLUMNS, "select * from stg")
def staged_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_lake(spark, sf_dir)["stg_grid_metrics"]


@register("fact_table", METRIC_COLUMNS, "select * from stg")
def fact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_lake(spark, sf_dir)["fct_grid_metrics"]


@register("full_rebuild", DAILY_COLUMNS, "select * from agg_load_daily")
def full_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-table builds instead of affected days."""
    lake = fresh_lake(spark)
    raw = raw_rows(spark, sf_dir)
    jobs.load_raw(lake, raw, [daily_window(day) for day in batch_days(raw)])
    jobs.rebuild(lake)
    return lake["agg_load_daily"]


@register("bound_sql", TOP_COLUMNS, "select * from agg_top_regions where rank <= 3")
def bound_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_lake(spark, sf_dir).sql(
        "select * from agg_top_regions where rank <= :top order by observation_date, rank", top=3
    )


@register(
    "row_snapshot",
    "row_json",
    """select to_json({'observation_date': strftime(observation_date, '%Y-%m-%d'),
        'region': region, 'region_name': region_name,
        'daily_total_load': round(daily_total_load, 2), 'rank': rank}) as row_json
        from agg_top_regions""",
)
def row_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = loaded_lake(spark, sf_dir)["agg_top_regions"]
    total = F.round("daily_total_load", 2)
    return snapshots.snapshot(ranks.withColumn("daily_total_load", total))


@register(
    "restamped_batch",
    "d:batch_date t:_ingestion_timestamp i:n_rows",
    """select batch_date, cast(batch_date as timestamp) + interval 3 hour
        as _ingestion_timestamp, count(*) as n_rows
        from raw where batch_date = (select max(batch_date) from raw) group by 1, 2""",
)
def restamped_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest batch copied to its own lake, then one column of it updated."""
    lake = loaded_lake(spark, sf_dir)
    copy = fresh_lake(spark, "copy")
    day = max(batch_days(lake["eia_grid_batch"]))
    lake.copy_batch(copy, day)
    stamp = datetime.combine(day, datetime.min.time(), UTC) + timedelta(hours=3)
    batch = F.col("batch_date") == F.lit(day)
    copy.set_column("eia_grid_batch", batch, "_ingestion_timestamp", F.lit(stamp))
    return (
        copy["eia_grid_batch"]
        .groupBy("batch_date", "_ingestion_timestamp")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


# Scalar functions


@register("staged_metrics", METRIC_COLUMNS, "select * from stg")
def staged_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_rows(spark, sf_dir)


@register(
    "period_parse",
    "i:event_id t:parsed d:parsed_date",
    """select event_id, parsed, cast(parsed as date) as parsed_date from (
        select event_id, case event_id % 6 when 0 then ts when 1 then ts - interval 2 hour
            when 2 then date_trunc('second', ts) when 3 then date_trunc('hour', ts)
            when 4 then cast(cast(ts as date) as timestamp) end as parsed from events)""",
)
def period_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three layouts with offsets and fractions, and texts that fit none."""
    ts = F.col("ts").cast("timestamp")
    full = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    kind = F.col("event_id") % 6
    text = (
        F.when(kind == 0, F.concat(full, F.lit("Z")))
        .when(kind == 1, F.concat(full, F.lit("+02:00")))
        .when(kind == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+0000'"))
        .when(kind == 3, F.date_format(ts, "yyyy-MM-dd'T'HH"))
        .when(kind == 4, F.date_format(ts, "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit("week "), F.date_format(ts, "D")))
    )
    parsed = periods.parse_period(text)
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id", parsed.alias("parsed"), F.to_date(parsed).alias("parsed_date")
    )


@register(
    "snake_labels",
    "label i:n_rows",
    """select lower(regexp_replace(o_orderpriority, '[^a-zA-Z0-9]+', '_', 'g')) as label,
        count(*) as n_rows from orders group by 1""",
)
def snake_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = metrics.snake_label(F.col("o_orderpriority")).alias("label")
    return table(spark, sf_dir, "orders").groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "blank_fuels",
    "metric_name energy_source i:n_rows",
    """select metric_name, energy_source, count(*) as n_rows from (
        select case when event_id % 5 = 4 then case when event_type = 'error' then 'demand'
                else event_type end else 'generation' end as metric_name,
            case event_id % 5 when 0 then 'NG' when 1 then 'SUN' end as energy_source
        from events) group by 1, 2""",
)
def blank_fuels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower case, padding and blanks: a blank fuel is generation without a source."""
    kind = F.col("event_id") % 5
    fuel = (
        F.when(kind == 0, " ng\t")
        .when(kind == 1, "Sun")
        .when(kind == 2, "")
        .when(kind == 3, "  ")
    )
    type_ = F.when(F.col("event_type") == "error", "d").otherwise(F.col("event_type"))
    name = metrics.metric_name(fuel, type_, F.col("event_type")).alias("metric_name")
    return (
        table(spark, sf_dir, "events")
        .groupBy(name, metrics.energy_source(fuel).alias("energy_source"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@register(
    "observation_freshness",
    "d:observation_date freshness source i:n_rows",
    """select observation_date,
        case when date_diff('second', observation_timestamp, timestamp '2024-01-20') <= 21600
            then 'fresh' else 'stale' end as freshness,
        case when date_diff('second', observation_timestamp, timestamp '2024-01-20') > 43200
            then 'error'
            when date_diff('second', observation_timestamp, timestamp '2024-01-20') > 21600
            then 'warn' else 'pass' end as source, count(*) as n_rows
        from stg group by 1, 2, 3""",
)
def observation_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment, checked = F.col("observation_timestamp"), F.lit(CHECKED)
    return (
        staged_rows(spark, sf_dir)
        .groupBy(
            "observation_date",
            status.freshness_status(moment, checked).alias("freshness"),
            status.source_status(moment, checked).alias("source"),
        )
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@register(
    "combined_freshness",
    "pipeline data combined i:n_rows",
    """select pipeline, data, case when pipeline = 'stale' or data = 'stale' then 'stale'
        when pipeline = 'fresh' and data = 'fresh' then 'fresh' else 'unknown' end as combined,
        count(*) as n_rows from (
        select case o_orderpriority when '1-URGENT' then 'fresh' when '2-HIGH' then 'stale'
                else 'unknown' end as pipeline,
            case o_orderstatus when 'F' then 'fresh' when 'O' then 'stale' else 'unknown' end
                as data from orders) group by 1, 2, 3""",
)
def combined_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses read off order codes, with NULL and unknown words among them."""
    priority = F.col("o_orderpriority")
    pipeline = F.when(priority == "1-URGENT", "fresh").when(priority == "2-HIGH", "stale")
    state = F.col("o_orderstatus")
    data = F.when(state == "F", "fresh").when(state == "O", "stale").otherwise("late")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            status.known_status(pipeline).alias("pipeline"),
            status.known_status(data).alias("data"),
            status.combined_status(pipeline, data).alias("combined"),
        )
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@register(
    "deviation_flags",
    "i:o_orderkey f:pct_deviation anomaly_flag",
    """select o_orderkey, pct as pct_deviation, coalesce(abs(pct) > 50, false) as anomaly_flag
        from (select o_orderkey, case when o_orderstatus = 'F' then null
            when o_orderstatus = 'O' then null
            else (o_totalprice - 250000.0) / 250000.0 * 100 end as pct from orders)""",
)
def deviation_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing, a zero and a plain baseline."""
    state = F.col("o_orderstatus")
    baseline = F.when(state == "O", 0.0).when(state != "F", 250000.0)
    deviation = scoring.pct_deviation(F.col("o_totalprice"), baseline)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        deviation.alias("pct_deviation"),
        scoring.anomaly_flag(deviation).alias("anomaly_flag"),
    )


@register(
    "region_matches",
    "region region_name i:n_requests",
    """select region, region_name, count(*) as n_requests from customer left join dim_region
        on c_custkey % 4 < 3 and region = 'R' || c_nationkey group by 1, 2""",
)
def region_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and names in other case, padded or unknown, resolved against the dimension."""
    kind = F.col("c_custkey") % 4
    requested = (
        F.when(kind == 0, F.concat(F.lit("r"), "c_nationkey"))
        .when(kind == 1, F.concat(F.lit(" nation_"), "c_nationkey", F.lit("  ")))
        .when(kind == 2, F.concat(F.lit("R"), "c_nationkey", F.lit("\t")))
        .otherwise(F.concat(F.lit("unknown "), "c_nationkey"))
    )
    requests = table(spark, sf_dir, "customer").select(requested.alias("requested"))
    dimension = views(spark, sf_dir)["dim_region"]
    return (
        serving.match_regions(requests, dimension)
        .groupBy("region", "region_name")
        .agg(F.count(F.lit(1)).alias("n_requests"))
    )


# Joins


@register(
    "affected_rows",
    METRIC_COLUMNS,
    """select stg.* from stg where observation_date in (
        select distinct cast(strptime(period, '%Y-%m-%dT%H') as date) from raw
        where batch_date >= date '2024-01-10')""",
)
def affected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged rows on the days that the batches since the tenth touch."""
    tables = views(spark, sf_dir)
    batches = tables["eia_grid_batch"].where(F.col("batch_date") >= F.lit(date(2024, 1, 10)))
    days = periods.in_dates(F.col("observation_date"), jobs.affected_dates(batches))
    return tables["stg_grid_metrics"].where(days)


@register(
    "orphan_references",
    "i:key i:n_rows",
    """select user_id as key, count(*) as n_rows from events
        where user_id not in (select s_suppkey from supplier) group by 1""",
)
def orphan_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event users without a supplier of that key."""
    check = quality.Check("child", "reference", ("key",), parent="parent")
    tables = {
        "child": table(spark, sf_dir, "events").select(F.col("user_id").alias("key")),
        "parent": table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key")),
    }
    return quality.violations(tables, check)


@register(
    "freshness_signals",
    "t:pipeline_freshness_timestamp t:data_freshness_timestamp",
    "select * from signals",
)
def freshness_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = views(spark, sf_dir)
    return control.freshness_signals(tables["eia_grid_batch"], tables["stg_grid_metrics"])


# Aggregates and windows


@register("load_hourly_table", HOURLY_COLUMNS, "select * from agg_load_hourly")
def load_hourly_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views(spark, sf_dir)["agg_load_hourly"]


@register("load_daily_table", DAILY_COLUMNS, "select * from agg_load_daily")
def load_daily_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views(spark, sf_dir)["agg_load_daily"]


@register("generation_mix_table", MIX_COLUMNS, "select * from agg_generation_mix")
def generation_mix_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views(spark, sf_dir)["agg_generation_mix"]


@register(
    "daily_totals",
    "d:observation_date region region_name f:daily_total_load",
    """select observation_date, region, region_name, total_load as daily_total_load
        from agg_load_daily""",
)
def daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_totals(views(spark, sf_dir)["agg_load_daily"])


@register("ranked_regions", TOP_COLUMNS, "select * from agg_top_regions")
def ranked_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views(spark, sf_dir)["agg_top_regions"]


@register("ranked_regions_in_ranges", TOP_COLUMNS, "select * from agg_top_regions")
def ranked_regions_in_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.top_regions(views(spark, sf_dir)["agg_load_daily"], range_rows=8)


@register(
    "rank_over_all_days",
    "d:observation_date region i:thousands i:rank",
    """select observation_date, region, thousands,
        rank() over (order by thousands desc nulls last, region) as rank
        from (select *, cast(floor(total_load / 1000) as bigint) as thousands from agg_load_daily)""",
)
def rank_over_all_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One group that holds all rows, with ties in value and name."""
    daily = views(spark, sf_dir)["agg_load_daily"].select(
        "observation_date",
        "region",
        F.floor(F.col("total_load") / 1000).alias("thousands"),
        F.lit(1).alias("all_days"),
    )
    ranked = ranked_in_ranges(
        daily, group="all_days", value="thousands", name="region", range_rows=16
    )
    return ranked.drop("all_days")


@register("dim_region", "region region_name", "select * from dim_region")
def dim_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views(spark, sf_dir)["dim_region"]


@register(
    "latest_names",
    "region region_name",
    """select respondent as region, name as region_name from (
        select 'R' || user_id as respondent, event_type as name, row_number() over (
            partition by user_id order by date_trunc('day', ts) desc,
            date_trunc('hour', ts) desc, event_type desc) as n from events) where n = 1""",
)
def latest_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions that change name all the time: ties on both times go to the greater name."""
    ts = F.col("ts").cast("timestamp")
    renamed = table(spark, sf_dir, "events").select(
        F.concat(F.lit("R"), "user_id").alias("region"),
        F.col("event_type").alias("region_name"),
        F.date_trunc("day", ts).alias("_ingestion_timestamp"),
        F.date_trunc("hour", ts).alias("observation_timestamp"),
    )
    return marts.dim_region(renamed)


@register("dim_energy_source", "energy_source", "select * from dim_energy_source")
def dim_energy_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views(spark, sf_dir)["dim_energy_source"]


@register(
    "affected_dates",
    "d:batch_date d:observation_date",
    """select distinct batch_date, cast(strptime(period, '%Y-%m-%dT%H') as date)
        as observation_date from raw""",
)
def affected_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_rows(spark, sf_dir)
    day = F.to_date(periods.parse_period(F.col("period")))
    return raw.select("batch_date", day.alias("observation_date")).distinct()


@register("observation_dates", "d:observation_date", "select distinct observation_date from stg")
def observation_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.observation_dates(raw_rows(spark, sf_dir))


@register(
    "daily_metrics",
    "d:observation_date region metric_name f:current_value",
    "select * from daily_metrics",
)
def daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = views(spark, sf_dir)
    return anomalies.daily_metrics(tables["agg_load_daily"], tables["agg_generation_mix"])


@register(
    "rolling_baseline",
    "d:observation_date region metric_name f:rolling_7d_avg",
    "select * from baseline",
)
def rolling_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = views(spark, sf_dir)
    daily = anomalies.daily_metrics(tables["agg_load_daily"], tables["agg_generation_mix"])
    return anomalies.with_baseline(daily).drop("current_value")


@register("anomaly_scores", SCORE_COLUMNS, "select * from scores")
def anomaly_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views(spark, sf_dir)["scores"]


@register(
    "generation_shares",
    "region d:observation_date energy_source f:generation_share_pct",
    """select region, observation_date, energy_source,
        case when total = 0 then 0.0 else round(daily_total_generation / total * 100, 2) end
            as generation_share_pct from (
        select *, sum(daily_total_generation) over (partition by region, observation_date)
            as total from agg_generation_mix)""",
)
def generation_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = serving.with_shares(views(spark, sf_dir)["agg_generation_mix"])
    return shares.select("region", "observation_date", "energy_source", "generation_share_pct")


@register(
    "date_scope_count",
    "i:n_rows",
    """select count(*) as n_rows from stg where observation_date in
        (date '2024-01-05', date '2024-01-06', date '2024-01-20')""",
)
def date_scope_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = [date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 20)]
    scope = periods.in_dates(F.col("observation_date"), days)
    return staged_rows(spark, sf_dir).where(scope).agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "run_result_totals",
    "i:models_passed i:tests_passed i:tests_failed i:bytes_processed",
    """select count(*) filter (event_type = 'view' and value < 50) as models_passed,
        count(*) filter (event_type in ('click', 'error') and value < 50) as tests_passed,
        count(*) filter (event_type in ('click', 'error') and value >= 50 and value < 80)
            as tests_failed,
        sum(case when event_type = 'signup' then 0 else cast(floor(value) as bigint) end)
            as bytes_processed from events""",
)
def run_result_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested result documents of up to a hundred entries each, made of the events."""
    kind, value = F.col("event_type"), F.col("value")
    prefix = (
        F.when(kind == "view", "model.")
        .when(kind.isin("click", "error"), "test.")
        .otherwise("source.")
    )
    good = F.when(kind == "error", "pass").otherwise("success")
    bad = F.when(kind == "error", "fail").otherwise("error")
    entry = F.struct(
        F.concat(prefix, F.col("event_id")).alias("unique_id"),
        F.when(value < 50, good).when(value < 80, bad).otherwise("skipped").alias("status"),
        F.struct(
            F.when(kind != "signup", F.floor(value).cast("long")).alias("bytes_processed")
        ).alias("adapter_response"),
    )
    documents = (
        table(spark, sf_dir, "events")
        .groupBy(F.floor(F.col("event_id") / 100).alias("document"))
        .agg(F.collect_list(entry).alias("results"))
    )
    return control.check_totals(control.run_result_rows(documents))


@register(
    "latency_summary",
    "endpoint f:count f:avg_ms f:p50_ms f:p95_ms f:p99_ms f:fastest_ms f:slowest_ms",
    """select event_type as endpoint, count(*) as count, avg(value) * 1000 as avg_ms,
        quantile_cont(value, 0.5) * 1000 as p50_ms, quantile_cont(value, 0.95) * 1000 as p95_ms,
        quantile_cont(value, 0.99) * 1000 as p99_ms, min(value) * 1000 as fastest_ms,
        max(value) * 1000 as slowest_ms from events group by 1""",
)
def latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = table(spark, sf_dir, "events").withColumnRenamed("event_type", "endpoint")
    return latency.latency_summary(requests, ["endpoint"], "value")


@register(
    "newest_batch",
    "key f:metric_value t:_ingestion_timestamp",
    """select key, value as metric_value, ingested as _ingestion_timestamp from (
        select event_type || user_id as key, value, date_trunc('day', ts) as ingested,
            max(date_trunc('day', ts)) over (partition by event_type, user_id) as newest
        from events) where ingested = newest""",
)
def newest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many batches per grain: all rows of each grain's newest day stay."""
    day = F.date_trunc("day", F.col("ts").cast("timestamp"))
    nothing = F.lit(None)
    staged = table(spark, sf_dir, "events").select(
        nothing.cast("string").alias("region"),
        nothing.cast("string").alias("region_name"),
        day.alias("observation_timestamp"),
        F.to_date(day).alias("observation_date"),
        F.col("event_type").alias("metric_name"),
        F.col("value").alias("metric_value"),
        nothing.cast("string").alias("energy_source"),
        nothing.cast("string").alias("unit"),
        F.concat("event_type", "user_id").alias("metric_surrogate_key"),
        day.alias("_ingestion_timestamp"),
    )
    return staging.newest_batch(staged).select(
        F.col("metric_surrogate_key").alias("key"), "metric_value", "_ingestion_timestamp"
    )


# Checks


def _check_sql(counts: dict[str, str]) -> str:
    arms = [
        f"select '{name}' as check_name, ({sql}) as n_broken" for name, sql in counts.items()
    ]
    return (
        "select *, case when n_broken > 0 then 'fail' else 'pass' end as status from ("
        + " union all ".join(arms)
        + ")"
    )


@register(
    "check_results",
    "check_name i:n_broken status",
    _check_sql({check.name: "0" for check in quality.CHECKS}),
)
def check_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.run_checks(built_lake(spark, sf_dir))


DIRTY = """
    select case when region = 'R3' then null else region end as region,
        observation_timestamp, observation_date, metric_name,
        case when metric_value > 100 then null else metric_value end as metric_value,
        case when energy_source = 'SUN' then 'COAL' else energy_source end as energy_source,
        metric_surrogate_key
    from stg
    union all
    select region, observation_timestamp, observation_date, 'other', metric_value,
        energy_source, metric_surrogate_key from stg where metric_name = 'demand'
    union all
    select region, observation_timestamp, observation_date, metric_name, metric_value,
        energy_source, metric_surrogate_key from stg where energy_source = 'NUC'
    union all
    select region, null, null, null, metric_value, energy_source, null from stg
        where region = 'R1'
"""
DIRTY_TABLES = {
    "stg_grid_metrics": DIRTY,
    "fct_grid_metrics": DIRTY,
    "dim_region": """select region from dim_region where region != 'R5'
        union all select null union all select region from dim_region where region = 'R2'""",
    "dim_energy_source": """select energy_source from dim_energy_source
        union all select null union all select 'NG'""",
}


def _broken_count(check: quality.Check) -> str:
    table, columns = DIRTY_TABLES[check.table], ", ".join(check.columns)
    if check.kind == "not_null":
        return f"select count(*) from ({table}) where {columns} is null"
    if check.kind == "accepted":
        known = ", ".join(f"'{value}'" for value in check.values)
        return f"select count(*) from ({table}) where {columns} not in ({known})"
    if check.kind == "unique":
        known = f"where {columns} is not null" if len(check.columns) == 1 else ""
        return f"""select count(*) from (
            select {columns} from ({table}) {known} group by all having count(*) > 1)"""
    return f"""select count(*) from ({table}) where {columns} is not null and {columns} not in (
        select {columns} from ({DIRTY_TABLES[check.parent]}) where {columns} is not null)"""


@register(
    "check_results_on_broken_rows",
    "check_name i:n_broken status",
    _check_sql({check.name: _broken_count(check) for check in quality.CHECKS}),
)
def check_results_on_broken_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs, unknown codes, repeated keys and orphans: every check has rows to find."""
    tables = views(spark, sf_dir)
    staged = tables["stg_grid_metrics"]
    value, source = F.col("metric_value"), F.col("energy_source")
    broken = staged.withColumns(
        {
            "region": F.when(F.col("region") != "R3", F.col("region")),
            "metric_value": F.when(value <= 100, value),
            "energy_source": F.when(source == "SUN", "COAL").otherwise(source),
        }
    )
    renamed = staged.where(F.col("metric_name") == "demand").withColumn(
        "metric_name", F.lit("other")
    )
    repeated = staged.where(source == "NUC")
    blank = staged.where(F.col("region") == "R1").withColumns(
        {
            name: F.lit(None).cast(staged.schema[name].dataType)
            for name in ("observation_timestamp", "observation_date", "metric_name", quality.KEY)
        }
    )
    rows = union_all([broken, renamed, repeated, blank])
    regions, sources = tables["dim_region"], tables["dim_energy_source"]
    nothing = spark.range(1)
    return quality.check_results(
        {
            "stg_grid_metrics": rows,
            "fct_grid_metrics": rows,
            "dim_region": union_all(
                [
                    regions.select("region").where("region != 'R5'"),
                    nothing.select(F.lit(None).cast("string").alias("region")),
                    regions.select("region").where("region = 'R2'"),
                ]
            ),
            "dim_energy_source": union_all(
                [
                    sources,
                    nothing.select(F.lit(None).cast("string").alias("energy_source")),
                    nothing.select(F.lit("NG").alias("energy_source")),
                ]
            ),
        }
    )


@register(
    "source_freshness",
    "t:max_loaded_at f:age_seconds status",
    """select max_loaded_at, date_diff('second', max_loaded_at, checked_at) as age_seconds,
        'pass' as status from (select max(_ingestion_timestamp) as max_loaded_at,
            max(cast(batch_date as timestamp)) + interval 27 hour as checked_at from raw)""",
)
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_rows(spark, sf_dir)
    return quality.source_freshness(raw, check_times(batch_days(raw))[0])


# Read queries over the written tables


@register(
    "load_hourly",
    HOURLY_COLUMNS,
    f"select * from agg_load_hourly where region = '{REGION}' and {BETWEEN}",
)
def load_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.load_metrics(built_lake(spark, sf_dir), REGION, FIRST, LAST, "hourly")


@register(
    "load_daily",
    DAILY_COLUMNS,
    f"select * from agg_load_daily where region = '{REGION}' and {BETWEEN}",
)
def load_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.load_metrics(built_lake(spark, sf_dir), REGION, FIRST, LAST, "daily")


@register(
    "load_daily_by_name",
    DAILY_COLUMNS,
    f"select * from agg_load_daily where region = '{REGION}' and {BETWEEN}",
)
def load_daily_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f" {REGION_NAME.lower()} "
    return serving.bounded_load(built_lake(spark, sf_dir), name, FIRST, LAST)


@register(
    "generation_mix",
    MIX_COLUMNS,
    f"select * from agg_generation_mix where region = '{REGION}' and {BETWEEN}",
)
def generation_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.generation_mix(built_lake(spark, sf_dir), REGION, FIRST, LAST)


@register(
    "generation_mix_with_shares",
    MIX_COLUMNS + " f:generation_share_pct",
    f"""select *, round(daily_total_generation / sum(daily_total_generation)
        over (partition by observation_date) * 100, 2) as generation_share_pct
        from agg_generation_mix where region = '{REGION}' and {BETWEEN}""",
)
def generation_mix_with_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.bounded_generation_mix(built_lake(spark, sf_dir), REGION, FIRST, LAST)


@register(
    "top_regions", TOP_COLUMNS, f"select * from agg_top_regions where rank <= 10 and {BETWEEN}"
)
def top_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.bounded_top_regions(built_lake(spark, sf_dir), FIRST, LAST)


@register(
    "latest_freshness",
    FRESHNESS_COLUMNS,
    f"""select *, 'fresh' as pipeline_freshness_status, 'stale' as data_freshness_status,
        'stale' as freshness_status from signals, {CHECKS_SQL} where run = 2""",
)
def latest_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_freshness(built_lake(spark, sf_dir))


@register(
    "freshness_log",
    "run_id t:pipeline_freshness_timestamp t:data_freshness_timestamp "
    "pipeline_freshness_status data_freshness_status t:checked_at",
    f"""select *, 'run' || run as run_id, 'fresh' as pipeline_freshness_status,
        case when date_diff('second', data_freshness_timestamp, checked_at) <= 21600
            then 'fresh' else 'stale' end as data_freshness_status
        from signals, {CHECKS_SQL}""",
)
def freshness_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built_lake(spark, sf_dir)["freshness_log"]


STATE_SQL = f"""
    select 'eia_grid_batch' as pipeline_name, checked_at as updated_at,
        (select cast(max(batch_date) as timestamp) from raw) as last_successful_window_start,
        (select cast(max(batch_date) as timestamp) + interval 1 day from raw)
            as last_successful_window_end,
        'run' || run as last_successful_run_id
    from {CHECKS_SQL} where run = 2
"""


@register("latest_run_state", STATE_COLUMNS, STATE_SQL)
def latest_run_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_run_state(built_lake(spark, sf_dir))


@register(
    "run_metrics",
    "run_id dag_id t:execution_date t:window_start t:window_end i:rows_loaded "
    "i:dbt_models_passed i:dbt_tests_passed i:dbt_tests_failed i:bytes_processed "
    "f:duration_seconds status t:created_at",
    f"""select 'run' || run as run_id, 'eia_grid_batch' as dag_id, window_end as execution_date,
        window_start, window_end, (select count(*) from raw) as rows_loaded,
        8 as dbt_models_passed, {len(quality.CHECKS)} as dbt_tests_passed,
        0 as dbt_tests_failed, 0 as bytes_processed, 600 as duration_seconds,
        'success' as status, checked_at as created_at
        from {CHECKS_SQL}, (select cast(max(batch_date) as timestamp) as window_start,
            cast(max(batch_date) as timestamp) + interval 1 day as window_end from raw)""",
)
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built_lake(spark, sf_dir)["run_metrics"]


@register(
    "anomalies_flagged",
    SCORE_COLUMNS + " t:checked_at",
    f"select * from scores, {CHECKS_SQL} where anomaly_flag",
)
def anomalies_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.anomalies(built_lake(spark, sf_dir))


@register(
    "anomalies_of_region",
    SCORE_COLUMNS + " t:checked_at",
    f"select * from scores, {CHECKS_SQL} where region = '{REGION}' and {BETWEEN}",
)
def anomalies_of_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = built_lake(spark, sf_dir)
    return serving.anomalies(lake, REGION, FIRST, LAST, flagged_only=False)


@register(
    "anomalies_latest_run",
    SCORE_COLUMNS + " t:checked_at",
    f"select * from scores, {CHECKS_SQL} where run = 2",
)
def anomalies_latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = built_lake(spark, sf_dir)
    return serving.anomalies(lake, flagged_only=False, latest_only=True)


@register(
    "anomalies_truncated",
    SCORE_COLUMNS + " t:checked_at truncated",
    f"""select *, (select 2 * count(*) > 200 from scores where anomaly_flag) as truncated
        from scores, {CHECKS_SQL} where anomaly_flag
        order by observation_date desc, checked_at desc, region, metric_name limit 200""",
)
def anomalies_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, over = serving.bounded_anomalies(built_lake(spark, sf_dir), max_rows=200)
    return rows.withColumn("truncated", F.lit(over))


@register(
    "flagged_counts",
    "i:flagged_rows i:returned_rows",
    f"""select count(*) filter (anomaly_flag) as flagged_rows, count(*) as returned_rows
        from scores, {CHECKS_SQL}""",
)
def flagged_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = serving.anomalies(built_lake(spark, sf_dir), flagged_only=False)
    return serving.flagged_count(rows)


SUMMARY_SQL = f"""
    select max(observation_date) as latest_observation_date,
        max(checked_at) as latest_anomaly_checked_at,
        count(*) filter (anomaly_flag) as flagged_anomaly_count_last_7_days,
        count(distinct case when anomaly_flag then region end) as affected_regions_last_7_days
    from scores, {CHECKS_SQL}
    where observation_date >= (select max(observation_date) - 6 from scores)
"""


@register("anomaly_summary", SUMMARY_COLUMNS, SUMMARY_SQL)
def anomaly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.anomaly_summary(built_lake(spark, sf_dir))


@register("date_bounds", "d:start_date d:end_date",
          "select min(observation_date) as start_date, max(observation_date) as end_date from stg "
          "where metric_name in ('demand', 'generation')")  # fmt: skip
def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.date_bounds(built_lake(spark, sf_dir))


@register("region_list", "region region_name", "select * from dim_region")
def region_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.regions(built_lake(spark, sf_dir))


@register("energy_source_list", "energy_source", "select * from dim_energy_source")
def energy_source_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.energy_sources(built_lake(spark, sf_dir))


@register(
    "response_metadata",
    "t:data_as_of pipeline_run_id freshness_status",
    """select data_freshness_timestamp as data_as_of, 'run2' as pipeline_run_id,
        'stale' as freshness_status from signals""",
)
def response_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.response_metadata(built_lake(spark, sf_dir))


@register(
    "load_summary_daily",
    "f:min_total_load f:max_total_load d:peak_date",
    f"""select min(total_load) as min_total_load, max(total_load) as max_total_load,
        arg_max(observation_date, total_load) as peak_date
        from agg_load_daily where region = '{REGION}' and {BETWEEN}""",
)
def load_summary_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = built_lake(spark, sf_dir)
    return serving.load_summary(serving.load_metrics(lake, REGION, FIRST, LAST, "daily"))


@register(
    "load_summary_hourly",
    "f:min_load f:max_load t:peak_timestamp",
    f"""select min(hourly_load) as min_load, max(hourly_load) as max_load,
        (select observation_timestamp from agg_load_hourly where region = '{REGION}' and {BETWEEN}
            order by hourly_load desc, observation_timestamp limit 1) as peak_timestamp
        from agg_load_hourly where region = '{REGION}' and {BETWEEN}""",
)
def load_summary_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = built_lake(spark, sf_dir)
    return serving.load_summary(serving.load_metrics(lake, REGION, FIRST, LAST, "hourly"))


@register(
    "data_quality_status",
    f"{FRESHNESS_COLUMNS} {STATE_COLUMNS} {SUMMARY_COLUMNS}",
    f"""select signals.*, 'fresh' as pipeline_freshness_status,
        'stale' as data_freshness_status, 'stale' as freshness_status,
        state.updated_at as checked_at, state.*, summary.*
        from signals, ({STATE_SQL}) as state, ({SUMMARY_SQL}) as summary""",
)
def data_quality_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.data_quality_status(built_lake(spark, sf_dir))


@register(
    "dominant_source",
    "energy_source f:total_generation",
    f"""select energy_source, sum(daily_total_generation) as total_generation
        from agg_generation_mix where region = '{REGION}' and {BETWEEN}
        group by 1 order by 2 desc limit 1""",
)
def dominant_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = built_lake(spark, sf_dir)
    return serving.dominant_source(serving.generation_mix(lake, REGION, FIRST, LAST))


@register(
    "latest_parameters",
    "region d:observation_date",
    """select region, observation_date from agg_load_daily
        order by observation_date desc, region limit 1""",
)
def latest_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_parameters(loaded_lake(spark, sf_dir)["agg_load_daily"])


# Write jobs


@register("load_table_written", DAILY_COLUMNS, "select * from agg_load_daily")
def load_table_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_lake(spark, sf_dir)["agg_load_daily"]


@register("mix_table_written", MIX_COLUMNS, "select * from agg_generation_mix")
def mix_table_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_lake(spark, sf_dir)["agg_generation_mix"]


@register("anomaly_table_written", SCORE_COLUMNS + " run_id t:checked_at",
          f"select *, 'run' || run as run_id from scores, {CHECKS_SQL}")
def anomaly_table_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built_lake(spark, sf_dir)["anomaly_results"]


DATA_TABLES = (
    "eia_grid_batch", "stg_grid_metrics", "fct_grid_metrics", "dim_region", "dim_energy_source",
    "agg_load_hourly", "agg_load_daily", "agg_generation_mix", "agg_top_regions",
)


def _differences(first: Lake, second: Lake, names: Iterable[str] = DATA_TABLES) -> DataFrame:
    return union_all(
        snapshots.differences(first[name], second[name]).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_differences")
        )
        for name in names
    )


@register(
    "rerun_differences",
    "table_name i:n_differences",
    f"select unnest({list(DATA_TABLES)}) as table_name, 0 as n_differences",
)
def rerun_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything loaded and rebuilt a second time: no row differs from the first."""
    first = built_lake(spark, sf_dir)
    second = fresh_lake(spark)
    raw = raw_rows(spark, sf_dir)
    windows = [daily_window(day) for day in batch_days(raw)]
    for _ in range(2):
        jobs.load_and_rebuild(second, raw.select(*RAW.fieldNames()), windows)
    return _differences(first, second)


@register("latest_load_only", DAILY_COLUMNS, """select * from agg_load_daily""")
def latest_load_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch days replaced whole: an early partial load of every day leaves no trace."""
    lake = fresh_lake(spark)
    raw = raw_rows(spark, sf_dir)
    days = batch_days(raw)
    mornings, rows = _half_days(raw, days, 0, 6)
    jobs.load_raw(lake, rows, mornings, jobs.REPLACE_DAY)
    jobs.load_raw(lake, raw, [daily_window(day) for day in days], jobs.REPLACE_DAY)
    jobs.build_staging(lake, batch_dates=days)
    jobs.build_fact(lake)
    jobs.build_aggregates(lake)
    return lake["agg_load_daily"]


def _half_days(
    raw: DataFrame, days: list[date], start: int, end: int
) -> tuple[list[BatchWindow], DataFrame]:
    """A window of some hours of every day, with the raw rows observed in these hours."""
    hour = timedelta(hours=1)
    windows = [
        BatchWindow(w.start + start * hour, w.start + end * hour) for w in map(daily_window, days)
    ]
    day = F.date_format("batch_date", "yyyyMMdd")
    ends = F.date_format(F.col("batch_date").cast("timestamp") + F.expr(f"interval {end} hours"),
                         "yyyyMMdd'T'HHmmss")
    batch = F.concat(day, F.lit(f"T{start:02}0000_"), ends)
    hours = F.substring("period", 12, 2).cast("int")
    return windows, raw.where(hours.between(start, end - 1)).withColumn("_batch_id", batch)


@register("dimension_after_failed_run", "region region_name", "select * from dim_region")
def dimension_after_failed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mornings are loaded by runs that then stop; the afternoons' runs name all regions."""
    lake = fresh_lake(spark)
    raw = raw_rows(spark, sf_dir)
    days = batch_days(raw)
    mornings, early = _half_days(raw, days, 0, 12)
    afternoons, late = _half_days(raw, days, 12, 24)
    jobs.load_raw(lake, early, mornings)
    jobs.load_and_rebuild(lake, late, afternoons)
    return lake["dim_region"]


@register("dimension_after_late_window", "region region_name", "select * from dim_region")
def dimension_after_late_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest half of the days first: older days that come late rename nothing."""
    lake = fresh_lake(spark)
    raw = raw_rows(spark, sf_dir)
    days = sorted(batch_days(raw), reverse=True)
    for some in (days[: len(days) // 2], days[len(days) // 2 :]):
        rows = raw.where(F.col("batch_date").isin(some))
        jobs.load_and_rebuild(lake, rows, [daily_window(day) for day in some])
    return lake["dim_region"]


@register(
    "column_update_inside_partition",
    "respondent _source_url i:n_rows",
    """select respondent, case when respondent = 'R7' then 'corrected' else _source_url end
        as _source_url, count(*) as n_rows from raw group by all""",
)
def column_update_inside_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One region's rows updated; the others of the same partitions stay as they are."""
    lake = fresh_lake(spark)
    raw = raw_rows(spark, sf_dir)
    jobs.load_raw(lake, raw, [daily_window(day) for day in batch_days(raw)])
    picked = F.col("respondent") == REGION
    lake.set_column("eia_grid_batch", picked, "_source_url", F.lit("corrected"))
    return lake["eia_grid_batch"].groupBy("respondent", "_source_url").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@register(
    "day_rebuild_equals_full_rebuild",
    "table_name i:n_differences i:n_rows",
    """select 'stg_grid_metrics' as table_name, 0 as n_differences,
        (select count(*) from stg) as n_rows""",
)
def day_rebuild_equals_full_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of every row with equal ingestion times: one of them stays, on any path."""
    raw = raw_rows(spark, sf_dir)
    days = batch_days(raw)
    lakes = []
    for dates in (days, None):
        lake = fresh_lake(spark)
        jobs.load_raw(lake, raw, [daily_window(day) for day in days])
        for start, end in ((0, 12), (12, 24)):
            windows, rows = _half_days(raw, days, start, end)
            jobs.load_raw(lake, rows, windows)
        jobs.build_staging(lake, dates)
        lakes.append(lake)
    staged = lakes[0]["stg_grid_metrics"].agg(F.count(F.lit(1)).alias("n_rows"))
    counted = staged.select(F.lit("stg_grid_metrics").alias("table_name"), "n_rows")
    return _differences(*lakes, ["stg_grid_metrics"]).join(counted, "table_name")


@register(
    "landed_microseconds",
    RAW_COLUMNS,
    """select * replace (_ingestion_timestamp + interval 123456 microsecond
        as _ingestion_timestamp) from raw""",
)
def landed_microseconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{fresh_lake(spark, 'landing').root}/grid"
    raw = raw_rows(spark, sf_dir)
    later = F.col("_ingestion_timestamp") + F.expr("interval 123456 microseconds")
    landing.land(raw.withColumn("_ingestion_timestamp", later), folder)
    windows = [daily_window(day) for day in batch_days(raw)]
    return landing.read_landed(spark, folder, windows)


@register("landed_window_run", DAILY_COLUMNS, "select * from agg_load_daily")
def landed_window_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page rows landed as one window, read back, and run from load to record."""
    lake = fresh_lake(spark)
    raw = raw_rows(spark, sf_dir)
    days = batch_days(raw)
    window = BatchWindow(daily_window(min(days)).start, daily_window(max(days)).end)
    rows = _paged(spark, sf_dir)
    landed = jobs.land_window(lake, f"{lake.root}/landing", window, rows, window.end)
    jobs.run_window(lake, landed, window, "landed", checked_at=window.end)
    return lake["agg_load_daily"]


@register(
    "bulk_run_metrics",
    "run_id t:window_start t:window_end i:rows_loaded i:dbt_tests_passed status",
    f"""select 'bulk__' || strftime(cast(batch_date as timestamp) + interval 1 day,
            '%Y-%m-%dT%H:%M:%S') || '+00:00' as run_id,
        cast(batch_date as timestamp) as window_start,
        cast(batch_date as timestamp) + interval 1 day as window_end, count(*) as rows_loaded,
        {len(quality.CHECKS)} as dbt_tests_passed, 'success' as status
        from raw group by batch_date""",
)
def bulk_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many windows run at once leave one record each."""
    lake = fresh_lake(spark)
    raw = raw_rows(spark, sf_dir)
    days = batch_days(raw)
    windows = [daily_window(day) for day in days]
    jobs.bulk_backfill(lake, raw, windows, checked_at=check_times(days)[0])
    return lake["run_metrics"].select(
        "run_id", "window_start", "window_end", "rows_loaded", "dbt_tests_passed", "status"
    )


def _streamed(spark: SparkSession, sf_dir: str) -> Lake:
    """All windows landed, then run as a stream of arriving files."""
    lake = fresh_lake(spark, "stream")
    landed = f"{lake.root}/landing"
    raw = raw_rows(spark, sf_dir)
    landing.land(raw, landed)
    checked = check_times(batch_days(raw))[0]
    load_arriving(lake, landed, f"{lake.root}/progress", checked_at=checked).awaitTermination()
    return lake


@register("streamed_load", DAILY_COLUMNS, "select * from agg_load_daily")
def streamed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir)["agg_load_daily"]


@register("streamed_anomalies", SCORE_COLUMNS, "select * from scores")
def streamed_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir)["anomaly_results"].drop("run_id", "checked_at")


STATUS_CHANGES_SQL = """
    with hours as (
        select distinct region as source, observation_timestamp as t from stg
        where region is not null and observation_timestamp is not null),
    gaps as (
        select source, t, until, lag(t) over w as before, lead(t) over w as after
        from hours, (select max(t) - interval 2 hour as until from hours)
        window w as (partition by source order by t)),
    spans as (select *, least(coalesce(after, until), until) as next from gaps where t < until)
    select source, 'pass' as status, t as changed_at from spans
        where before is null or t > before + interval 6 hour
    union all select source, 'warn', t + interval 6 hour from spans where t + interval 6 hour < next
    union all select source, 'error', t + interval 12 hour from spans
        where t + interval 12 hour < next
"""


@register("status_changes", "source status t:changed_at", STATUS_CHANGES_SQL)
def status_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All landed windows as a stream, with a timer for every silent source."""
    root = fresh_lake(spark, "staleness").root
    landing.land(raw_rows(spark, sf_dir), f"{root}/landing")
    arrived = spark.readStream.schema(RAW).option("mode", "FAILFAST").json(f"{root}/landing")
    observed = arrived.select(
        F.col("respondent").alias("region"),
        periods.parse_period(F.col("period")).alias("observation_timestamp"),
    )
    stream = staleness.status_changes(observed).writeStream.format("parquet")
    stream = stream.option("checkpointLocation", f"{root}/progress").trigger(availableNow=True)
    stream.start(f"{root}/changes").awaitTermination()
    return spark.read.parquet(f"{root}/changes")


@register("past_status_changes", "source status t:changed_at", STATUS_CHANGES_SQL)
def past_status_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged_rows(spark, sf_dir)
    newest = rows.agg(F.max("observation_timestamp")).first()[0]
    return staleness.past_status_changes(rows, newest.astimezone(UTC) - staleness.DELAY)


# The partition book and the segmented logs


@register(
    "raw_manifest",
    "d:batch_date _batch_id d:observation_date i:n_rows t:newest_ingestion",
    """select batch_date, _batch_id, cast(strptime(period, '%Y-%m-%dT%H') as date)
        as observation_date, count(*) as n_rows, max(_ingestion_timestamp) as newest_ingestion
        from raw group by 1, 2, 3""",
)
def raw_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and batches of raw as the book has them, without a look at raw."""
    entries = built_lake(spark, sf_dir).book.partitions("eia_grid_batch")
    return entries.select(
        "batch_date", "_batch_id", "observation_date", "n_rows", "newest_ingestion"
    )


DAY_TABLES_SQL = """
    select 'stg_grid_metrics' as table_name, observation_date, count(*) as n_rows,
        max(_ingestion_timestamp) as newest_ingestion, min(observation_timestamp) as first_observation,
        max(observation_timestamp) as last_observation from stg group by 2
    union all select 'fct_grid_metrics', observation_date, count(*), max(_ingestion_timestamp),
        min(observation_timestamp), max(observation_timestamp) from stg group by 2
    union all select 'agg_load_hourly', observation_date, count(*), null,
        min(observation_timestamp), max(observation_timestamp) from agg_load_hourly group by 2
    union all select 'agg_load_daily', observation_date, count(*), null, null, null
        from agg_load_daily group by 2
    union all select 'agg_generation_mix', observation_date, count(*), null, null, null
        from agg_generation_mix group by 2
    union all select 'agg_top_regions', observation_date, count(*), null, null, null
        from agg_top_regions group by 2
"""
DAY_COLUMNS = (
    "table_name d:observation_date i:n_rows t:newest_ingestion t:first_observation t:last_observation"
)


def _day_entries(lake: Lake) -> DataFrame:
    tables = [name for name in BOOKED if name not in ("eia_grid_batch", "anomaly_results")]
    return union_all(lake.book.partitions(name) for name in tables).select(
        "table_name", "observation_date", "n_rows", "newest_ingestion", "first_observation", "last_observation"
    )


@register("day_extremes", DAY_COLUMNS, DAY_TABLES_SQL)
def day_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and extremes of every day of every table, from the book."""
    return _day_entries(built_lake(spark, sf_dir))


@register(
    "scored_days",
    "d:observation_date i:n_rows t:newest_check i:n_flagged regions",
    f"""select observation_date, count(*) as n_rows, max(checked_at) as newest_check,
        count(*) filter (anomaly_flag) as n_flagged, coalesce(string_agg(distinct
            case when anomaly_flag then region end, ',' order by
            case when anomaly_flag then region end), '') as regions
        from scores, {CHECKS_SQL} group by 1""",
)
def scored_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags by day after two runs over all of them, from the book."""
    days = built_lake(spark, sf_dir).book.partitions("anomaly_results")
    return days.select(
        "observation_date",
        "n_rows",
        "newest_check",
        "n_flagged",
        F.array_join("flagged_regions", ",").alias("regions"),
    )


# What is left of the rows after the second load: no demand on even days, nothing on the last.
LEFT_SQL = """select * from {0} where observation_date < (select max(observation_date) from stg)
    and (day(observation_date) % 2 = 1 or {1})"""


def _reloaded(spark: SparkSession, sf_dir: str) -> Lake:
    """All windows loaded, then loaded again with fewer rows; the second rebuild stops half-way
    and is done again."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RELOADED:
        lake = fresh_lake(spark, "reloaded")
        raw = raw_rows(spark, sf_dir)
        days = batch_days(raw)
        windows = [daily_window(day) for day in days]
        jobs.load_and_rebuild(lake, raw, windows)
        demand = F.col("type") == "D"
        fewer = raw.where((F.col("batch_date") < F.lit(max(days))) & ((F.day("batch_date") % 2 == 1) | ~demand))
        loaded = jobs.load_raw(lake, fewer, windows)
        try:
            with lake.book.changing({"agg_load_daily": day_leaves(loaded.affected_dates)}):
                raise InterruptedError
        except InterruptedError:
            jobs.rebuild(lake, loaded.affected_dates)
        _RELOADED[key] = lake
    return _RELOADED[key]


_RELOADED: dict[tuple[str, str], Lake] = {}


@register(
    "day_extremes_after_reload",
    "table_name d:observation_date i:n_rows t:last_observation",
    f"""with left_stg as ({LEFT_SQL.format("stg", "metric_name <> 'demand'")}),
        left_daily as ({LEFT_SQL.format("agg_load_daily", "false")})
    select 'stg_grid_metrics' as table_name, observation_date, count(*) as n_rows,
        max(observation_timestamp) as last_observation from left_stg group by 2
    union all select 'agg_load_daily', observation_date, count(*), null from left_daily group by 2""",
)
def day_extremes_after_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that a second load changed, emptied or dropped."""
    days = _day_entries(_reloaded(spark, sf_dir))
    chosen = days.where(F.col("table_name").isin("stg_grid_metrics", "agg_load_daily"))
    return chosen.select("table_name", "observation_date", "n_rows", "last_observation")


@register(
    "bounds_after_reload",
    "d:start_date d:end_date t:pipeline_freshness_timestamp t:data_freshness_timestamp",
    f"""with left_stg as ({LEFT_SQL.format("stg", "metric_name <> 'demand'")})
    select min(observation_date) filter (metric_name = 'demand' or energy_source is not null)
            as start_date,
        max(observation_date) filter (metric_name = 'demand' or energy_source is not null)
            as end_date,
        max(_ingestion_timestamp) as pipeline_freshness_timestamp,
        max(observation_timestamp) as data_freshness_timestamp
    from left_stg""",
)
def bounds_after_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds and newest times of what is left, from the book alone."""
    lake = _reloaded(spark, sf_dir)
    signals = control.freshness_signals(jobs.newest_ingestions(lake), jobs.newest_observations(lake))
    bounds = serving.date_bounds(lake)
    stacked = bounds.unionByName(signals, allowMissingColumns=True)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def _logged(spark: SparkSession, sf_dir: str) -> Lake:
    """A freshness check after each batch day, each an append of its own."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOGGED:
        lake, source = fresh_lake(spark, "logged"), built_lake(spark, sf_dir)
        signals = control.freshness_signals(
            jobs.newest_ingestions(source), jobs.newest_observations(source)
        )
        for day in batch_days(source["eia_grid_batch"]):
            checked_at = datetime.combine(day, datetime.min.time(), UTC) + timedelta(hours=29)
            lake.append("freshness_log", control.freshness_row(signals, f"check-{day}", checked_at))
        _LOGGED[key] = lake
    return _LOGGED[key]


_LOGGED: dict[tuple[str, str], Lake] = {}

LOGGED_SQL = """select 'check-' || strftime(d, '%Y-%m-%d') as run_id, pipeline_freshness_timestamp,
    data_freshness_timestamp,
    case when date_diff('microsecond', pipeline_freshness_timestamp, moment) <= 21600000000 then 'fresh'
        else 'stale' end as pipeline_freshness_status,
    case when date_diff('microsecond', data_freshness_timestamp, moment) <= 21600000000 then 'fresh'
        else 'stale' end as data_freshness_status, moment as checked_at
    from signals, (select distinct batch_date as d, cast(batch_date as timestamp) + interval 29 hour as moment
        from raw)"""
LOGGED_COLUMNS = (
    "run_id t:pipeline_freshness_timestamp t:data_freshness_timestamp pipeline_freshness_status "
    "data_freshness_status t:checked_at"
)


@register("merged_log", LOGGED_COLUMNS, LOGGED_SQL)
def merged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks, after their segments were merged."""
    return _logged(spark, sf_dir)["freshness_log"]


@register(
    "newest_log_row",
    LOGGED_COLUMNS,
    f"select * from ({LOGGED_SQL}) order by checked_at desc limit 1",
)
def newest_log_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest check, from the one segment that names its time."""
    newest = _logged(spark, sf_dir).newest("freshness_log")
    return newest.orderBy(F.col("checked_at").desc()).limit(1)


@register(
    "changed_partitions",
    "side d:observation_date metric_surrogate_key f:metric_value",
    """select side, observation_date, metric_surrogate_key,
        metric_value + case side when 'after' then 1 else 0 end as metric_value
        from stg, (values ('before'), ('after')) as sides(side)
        where region = 'R7' and metric_name = 'demand' and day(observation_date) % 10 = 3""",
)
def changed_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few rows of the fact changed, found by the fingerprints of its days."""
    before = built_lake(spark, sf_dir)["fct_grid_metrics"]
    planted = (F.col("region") == "R7") & (F.col("metric_name") == "demand") & (F.day("observation_date") % 10 == 3)
    value = F.col("metric_value") + F.when(planted, 1.0).otherwise(0.0)
    found = snapshots.partition_differences(before, before.withColumn("metric_value", value), "observation_date")
    return found.select("side", "observation_date", "metric_surrogate_key", "metric_value")


def _after_a_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of a fact whose every sixth hour was first loaded with other values and for a
    region that it is not about, once these rows were replaced."""
    fact = staged_rows(spark, sf_dir)
    again = F.coalesce(F.hour("observation_timestamp") % 6 == 0, F.lit(False))
    after = fact.where(again)
    other = after.where("region = 'R7'").withColumn("region", F.lit("R7X"))
    before = after.withColumn("metric_value", F.col("metric_value") * 2 + 1).unionByName(other)
    held = deltas.states(fact.where(~again).unionByName(before))
    return deltas.replaced(held, before, after, fact)


@register("load_daily_by_changes", DAILY_COLUMNS, "select * from agg_load_daily")
def load_daily_by_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deltas.load_daily(_after_a_replacement(spark, sf_dir))


@register("generation_mix_by_changes", MIX_COLUMNS, "select * from agg_generation_mix")
def generation_mix_by_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deltas.generation_mix(_after_a_replacement(spark, sf_dir))
