"""Reference SQL of the derived tables, written for DuckDB over the given parquet tables."""

BASE = """
hourly as (
    select date_trunc('hour', ts) as hour, cast(user_id % 25 as integer) as k, event_type,
        case when event_type = 'purchase'
            then list_extract(['NG', 'SUN', 'WND', 'NUC'], cast(event_id % 4 + 1 as integer)) end
            as fueltype,
        round(sum(value), 2) as value
    from events group by 1, 2, 3, 4
),
raw as (
    select 'R' || k as respondent, n_name as respondent_name,
        case event_type when 'error' then 'D' when 'click' then 'DF' when 'view' then 'NG'
            when 'signup' then 'TI' else 'generation' end as type,
        case event_type when 'error' then 'Demand' when 'click' then 'Day-ahead demand forecast'
            when 'view' then 'Net generation' when 'signup' then 'Total interchange'
            else 'Generation' end as type_name,
        value, ' MegawattHours ' as value_units, strftime(hour, '%Y-%m-%dT%H') as period,
        fueltype,
        case fueltype when 'NG' then 'Natural gas' when 'SUN' then 'Solar'
            when 'WND' then 'Wind' when 'NUC' then 'Nuclear' end as fueltype_name,
        cast(hour as date) as batch_date,
        strftime(date_trunc('day', hour), '%Y%m%dT%H%M%S') || '_'
            || strftime(date_trunc('day', hour) + interval 1 day, '%Y%m%dT%H%M%S') as _batch_id,
        'events/' || case when fueltype is null then 'region' else 'fuel_type' end as _source_url,
        cast(hour as timestamp) + interval 65 minute as _ingestion_timestamp
    from hourly join nation on n_nationkey = k
),
stg as (
    select *, cast(observation_timestamp as date) as observation_date,
        md5(region || '-' || strftime(observation_timestamp, '%Y-%m-%d %H:%M:%S') || '+00-'
            || metric_name || '-' || coalesce(energy_source, '_dbt_utils_surrogate_key_null_'))
            as metric_surrogate_key
    from (
        select respondent as region, respondent_name as region_name,
            coalesce(try_strptime(period, '%Y-%m-%dT%H'), try_strptime(period, '%Y-%m-%d'))
                as observation_timestamp,
            case when fueltype is not null then 'generation'
                when lower(type_name) = 'demand' or lower(type) = 'd' then 'demand'
                else lower(regexp_replace(type_name, '[^a-zA-Z0-9]+', '_', 'g')) end
                as metric_name,
            cast(value as double) as metric_value,
            nullif(upper(trim(fueltype)), '') as energy_source,
            lower(trim(value_units)) as unit, _ingestion_timestamp
        from raw
    )
),
dim_region as (
    select region, region_name from (
        select region, region_name, row_number() over (partition by region
            order by _ingestion_timestamp desc, observation_timestamp desc, region_name desc) as n
        from stg where region is not null)
    where n = 1
),
dim_energy_source as (
    select distinct energy_source from stg where energy_source is not null
),
agg_load_hourly as (
    select region, region_name, observation_timestamp, observation_date,
        metric_value as hourly_load, unit
    from stg where metric_name = 'demand'
),
agg_load_daily as (
    select region, region_name, observation_date, avg(metric_value) as avg_load,
        min(metric_value) as min_load, max(metric_value) as max_load,
        sum(metric_value) as total_load, min(unit) as unit
    from stg where metric_name = 'demand' group by region, region_name, observation_date
),
agg_generation_mix as (
    select region, region_name, observation_date, energy_source,
        sum(metric_value) as daily_total_generation, min(unit) as unit
    from stg where metric_name = 'generation' and energy_source is not null
    group by region, region_name, observation_date, energy_source
),
agg_top_regions as (
    select observation_date, region, region_name, daily_total_load,
        rank() over (partition by observation_date
            order by daily_total_load desc, region asc) as rank
    from (select observation_date, region, region_name, round(sum(metric_value), 6)
              as daily_total_load
          from stg where metric_name = 'demand' group by 1, 2, 3)
),
daily_metrics as (
    select observation_date, region, 'demand' as metric_name, total_load as current_value
    from agg_load_daily
    union all
    select observation_date, region, 'generation', sum(daily_total_generation)
    from agg_generation_mix group by observation_date, region
),
baseline as (
    select c.observation_date, c.region, c.metric_name, avg(h.current_value) as rolling_7d_avg
    from daily_metrics as c left join daily_metrics as h
        on h.region = c.region and h.metric_name = c.metric_name
        and h.observation_date between c.observation_date - 7 and c.observation_date - 1
    group by 1, 2, 3
),
scores as (
    select *, coalesce(abs(pct_deviation) > 50, false) as anomaly_flag
    from (
        select c.observation_date, c.region, c.metric_name, c.current_value, b.rolling_7d_avg,
            case when b.rolling_7d_avg is null or b.rolling_7d_avg = 0 then null
                else (c.current_value - b.rolling_7d_avg) / b.rolling_7d_avg * 100 end
                as pct_deviation
        from daily_metrics as c left join baseline as b
            on b.observation_date = c.observation_date and b.region = c.region
            and b.metric_name = c.metric_name
    )
),
signals as (
    select (select max(_ingestion_timestamp) from raw) as pipeline_freshness_timestamp,
        (select max(observation_timestamp) from stg) as data_freshness_timestamp
)
"""

RAW_COLUMNS = (
    "respondent respondent_name type type_name f:value value_units period fueltype "
    "fueltype_name d:batch_date _batch_id _source_url t:_ingestion_timestamp"
)
METRIC_COLUMNS = (
    "region region_name t:observation_timestamp d:observation_date metric_name f:metric_value "
    "energy_source unit metric_surrogate_key t:_ingestion_timestamp"
)
HOURLY_COLUMNS = (
    "region region_name t:observation_timestamp d:observation_date f:hourly_load unit"
)
DAILY_COLUMNS = (
    "region region_name d:observation_date f:avg_load f:min_load f:max_load f:total_load unit"
)
MIX_COLUMNS = "region region_name d:observation_date energy_source f:daily_total_generation unit"
TOP_COLUMNS = "d:observation_date region region_name f:daily_total_load i:rank"
SCORE_COLUMNS = (
    "d:observation_date region metric_name f:current_value f:rolling_7d_avg f:pct_deviation "
    "anomaly_flag"
)
STATE_COLUMNS = (
    "pipeline_name t:last_successful_window_start t:last_successful_window_end "
    "last_successful_run_id t:updated_at"
)
FRESHNESS_COLUMNS = (
    "t:pipeline_freshness_timestamp t:data_freshness_timestamp pipeline_freshness_status "
    "data_freshness_status freshness_status t:checked_at"
)
SUMMARY_COLUMNS = (
    "d:latest_observation_date t:latest_anomaly_checked_at i:flagged_anomaly_count_last_7_days "
    "i:affected_regions_last_7_days"
)
