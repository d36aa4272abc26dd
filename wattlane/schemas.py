"""Table and page schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(*field) for field in fields])


STRING, DOUBLE, LONG = T.StringType(), T.DoubleType(), T.LongType()
DATE, TIMESTAMP, BOOLEAN = T.DateType(), T.TimestampType(), T.BooleanType()

PAGE_ROW = _struct(
    ("period", STRING),
    ("respondent", STRING),
    ("respondent-name", STRING),
    ("type", STRING),
    ("fueltype", STRING),
    ("type-name", STRING),
    ("value", STRING),
    ("value-units", STRING),
)
PAGE = _struct(("response", _struct(("total", STRING), ("data", T.ArrayType(PAGE_ROW)))))

RAW = _struct(
    ("respondent", STRING, False),
    ("respondent_name", STRING, False),
    ("type", STRING, False),
    ("type_name", STRING, False),
    ("value", DOUBLE, False),
    ("value_units", STRING, False),
    ("period", STRING, False),
    ("fueltype", STRING),
    ("fueltype_name", STRING),
    ("batch_date", DATE, False),
    ("_batch_id", STRING, False),
    ("_source_url", STRING, False),
    ("_ingestion_timestamp", TIMESTAMP, False),
)

METRICS = _struct(
    ("region", STRING),
    ("region_name", STRING),
    ("observation_timestamp", TIMESTAMP),
    ("observation_date", DATE),
    ("metric_name", STRING),
    ("metric_value", DOUBLE),
    ("energy_source", STRING),
    ("unit", STRING),
    ("metric_surrogate_key", STRING),
    ("_ingestion_timestamp", TIMESTAMP),
)

DIM_REGION = _struct(("region", STRING), ("region_name", STRING))
DIM_ENERGY_SOURCE = _struct(("energy_source", STRING))

AGG_LOAD_HOURLY = _struct(
    ("region", STRING),
    ("region_name", STRING),
    ("observation_timestamp", TIMESTAMP),
    ("observation_date", DATE),
    ("hourly_load", DOUBLE),
    ("unit", STRING),
)
AGG_LOAD_DAILY = _struct(
    ("region", STRING),
    ("region_name", STRING),
    ("observation_date", DATE),
    ("avg_load", DOUBLE),
    ("min_load", DOUBLE),
    ("max_load", DOUBLE),
    ("total_load", DOUBLE),
    ("unit", STRING),
)
AGG_GENERATION_MIX = _struct(
    ("region", STRING),
    ("region_name", STRING),
    ("observation_date", DATE),
    ("energy_source", STRING),
    ("daily_total_generation", DOUBLE),
    ("unit", STRING),
)
AGG_TOP_REGIONS = _struct(
    ("observation_date", DATE),
    ("region", STRING),
    ("region_name", STRING),
    ("daily_total_load", DOUBLE),
    ("rank", LONG),
)

PIPELINE_STATE = _struct(
    ("pipeline_name", STRING, False),
    ("last_successful_window_start", TIMESTAMP),
    ("last_successful_window_end", TIMESTAMP),
    ("last_successful_run_id", STRING),
    ("updated_at", TIMESTAMP),
)
RUN_METRICS = _struct(
    ("run_id", STRING, False),
    ("dag_id", STRING, False),
    ("execution_date", TIMESTAMP),
    ("window_start", TIMESTAMP),
    ("window_end", TIMESTAMP),
    ("rows_loaded", LONG),
    ("dbt_models_passed", LONG),
    ("dbt_tests_passed", LONG),
    ("dbt_tests_failed", LONG),
    ("bytes_processed", LONG),
    ("duration_seconds", DOUBLE),
    ("status", STRING),
    ("created_at", TIMESTAMP),
)
FRESHNESS_LOG = _struct(
    ("run_id", STRING, False),
    ("pipeline_freshness_timestamp", TIMESTAMP),
    ("data_freshness_timestamp", TIMESTAMP),
    ("pipeline_freshness_status", STRING),
    ("data_freshness_status", STRING),
    ("checked_at", TIMESTAMP),
)
ANOMALY_RESULTS = _struct(
    ("observation_date", DATE, False),
    ("region", STRING, False),
    ("metric_name", STRING, False),
    ("current_value", DOUBLE),
    ("rolling_7d_avg", DOUBLE),
    ("pct_deviation", DOUBLE),
    ("anomaly_flag", BOOLEAN),
    ("run_id", STRING, False),
    ("checked_at", TIMESTAMP),
)

#: What is known of every partition of the tables that jobs write, an entry for each change.
PARTITION_BOOK = _struct(
    ("table_name", STRING, False),
    ("scope", STRING, False),
    ("batch_date", DATE),
    ("_batch_id", STRING),
    ("observation_date", DATE),
    ("entry", LONG, False),
    ("pending", BOOLEAN, False),
    ("n_rows", LONG),
    ("newest_ingestion", TIMESTAMP),
    ("first_observation", TIMESTAMP),
    ("last_observation", TIMESTAMP),
    ("newest_check", TIMESTAMP),
    ("n_flagged", LONG),
    ("flagged_regions", T.ArrayType(STRING)),
)

RUN_RESULTS = _struct(
    (
        "results",
        T.ArrayType(
            _struct(
                ("unique_id", STRING),
                ("status", STRING),
                ("adapter_response", _struct(("bytes_processed", LONG))),
            )
        ),
    )
)


@dataclass(frozen=True)
class Table:
    """Where a table lives and how its files are laid out."""

    dataset: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    # Columns kept in the file layout only, not part of the row contract.
    layout_only: tuple[T.StructField, ...] = ()
    # A growing log in merged segments, by a time column, or of entries by keys.
    newest_by: str = ""
    keys: tuple[str, ...] = ()

    @property
    def stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, *self.layout_only])

    @property
    def segmented(self) -> bool:
        return bool(self.newest_by or self.keys)

    @property
    def required(self) -> list[str]:
        return [field.name for field in self.schema.fields if not field.nullable]


BY_DAY = ("observation_date",)

TABLES = {
    # The observation date is kept in the layout so that a day can be rebuilt from
    # every batch that touches it without reading any other day.
    "eia_grid_batch": Table(
        "raw",
        RAW,
        ("batch_date", "_batch_id", "observation_date"),
        ("respondent",),
        (T.StructField("observation_date", DATE),),
    ),
    "stg_grid_metrics": Table("staging", METRICS, BY_DAY, ("region", "metric_name")),
    "fct_grid_metrics": Table("marts", METRICS, BY_DAY, ("region", "metric_name")),
    # The times that order names are kept, so that a merge is right in any order of loads.
    "dim_region": Table(
        "marts",
        DIM_REGION,
        layout_only=(
            T.StructField("_ingestion_timestamp", TIMESTAMP),
            T.StructField("observation_timestamp", TIMESTAMP),
        ),
    ),
    "dim_energy_source": Table("marts", DIM_ENERGY_SOURCE),
    "agg_load_hourly": Table("marts", AGG_LOAD_HOURLY, BY_DAY, ("region", "observation_timestamp")),
    "agg_load_daily": Table("marts", AGG_LOAD_DAILY, BY_DAY, ("region",)),
    "agg_generation_mix": Table("marts", AGG_GENERATION_MIX, BY_DAY, ("region", "energy_source")),
    "agg_top_regions": Table("marts", AGG_TOP_REGIONS, BY_DAY, ("rank",)),
    "pipeline_state": Table("meta", PIPELINE_STATE, ("pipeline_name",)),
    "run_metrics": Table("meta", RUN_METRICS, sort_by=("created_at",), newest_by="created_at"),
    "freshness_log": Table("meta", FRESHNESS_LOG, sort_by=("checked_at",), newest_by="checked_at"),
    "partition_book": Table(
        "meta",
        PARTITION_BOOK,
        sort_by=("table_name", "observation_date"),
        keys=("table_name", "scope", "batch_date", "_batch_id", "observation_date"),
    ),
    "anomaly_results": Table("meta", ANOMALY_RESULTS, BY_DAY, ("region", "metric_name")),
}
