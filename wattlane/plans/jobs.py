"""Write jobs: load windows, rebuild the affected days, check, score and record."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wattlane.functions.periods import parse_period, with_history
from wattlane.functions.scoring import BASELINE_DAYS
from wattlane.lake import Lake, day_leaves, enforce
from wattlane.operators import anomalies, control, marts, quality, staging
from wattlane.operators.ingest import normalise, require_rows, stamp_batch
from wattlane.schemas import RAW, TABLES
from wattlane.sources.landing import enforce_required, land, read_landed
from wattlane.window import BatchWindow, utc_now

LOGGER = logging.getLogger(__name__)

RAW_TABLE = "eia_grid_batch"
DAY = "observation_date"

# What a load replaces: its own windows, or the whole batch days they fall on.
REPLACE_WINDOW = "window"
REPLACE_DAY = "day"

MODELS = (
    "stg_grid_metrics",
    "fct_grid_metrics",
    "dim_region",
    "dim_energy_source",
    "agg_load_hourly",
    "agg_load_daily",
    "agg_generation_mix",
    "agg_top_regions",
)


@dataclass(frozen=True)
class Loaded:
    """What a load wrote and which days it touched."""

    rows_by_batch: dict[str, int]
    batch_dates: list[date]
    affected_dates: list[date]

    @property
    def rows(self) -> int:
        return sum(self.rows_by_batch.values())


def load_raw(
    lake: Lake, rows: DataFrame, windows: Iterable[BatchWindow], replace: str = REPLACE_WINDOW
) -> Loaded:
    """Write the raw rows of one or many windows in one job.

    Rerunning a window replaces that window. With ``replace="day"`` a load also drops the
    other windows of its batch days, so that a day holds its latest load only. Days that
    only the replaced rows touched count as affected. They are read off the partition
    listing, so finding them costs no scan. A row of a window that is not declared fails the
    job in the same pass.
    """
    windows = list(windows)
    batch_dates = sorted({window.batch_date for window in windows})
    leaves = {"batch_date": {day.isoformat() for day in batch_dates}}
    ids = {window.batch_id for window in windows}
    if replace == REPLACE_WINDOW:
        leaves["_batch_id"] = ids
    table = _declared(enforce_required(rows), windows).select(
        *RAW.fieldNames(), F.to_date(parse_period(F.col("period"))).alias("observation_date")
    )
    # A day's load also drops batches that it does not name.
    entered = leaves if replace == REPLACE_WINDOW else lake.book.batches_of(batch_dates, ids)
    with lake.book.changing({RAW_TABLE: entered}):
        stale = lake.replace_partitions(RAW_TABLE, table, leaves)
        written_leaves = {file.rsplit("/", 1)[0] for file in lake.files(RAW_TABLE, leaves)}
    return Loaded(
        rows_by_batch=_written_rows(lake, windows),
        batch_dates=batch_dates,
        affected_dates=sorted(_leaf_dates(written_leaves.union(stale))),
    )


def _written_rows(lake: Lake, windows: list[BatchWindow]) -> dict[str, int]:
    """Rows of each window as the files have them: tasks run twice do not count twice."""
    ids = [window.batch_id for window in windows]
    held = lake.book.partitions(RAW_TABLE).where(F.col("_batch_id").isin(*ids))
    counts = held.groupBy("_batch_id").agg(F.sum("n_rows").alias("n_rows")).collect()
    return {row["_batch_id"]: row["n_rows"] for row in counts}


def _declared(rows: DataFrame, windows: Iterable[BatchWindow]) -> DataFrame:
    """The rows; the job fails on one whose batch is not that of a declared window."""
    batch = F.concat_ws("/", F.col("batch_date").cast("string"), "_batch_id")
    known = batch.isin(*{f"{w.batch_date.isoformat()}/{w.batch_id}" for w in windows})
    strange = F.concat(F.lit("rows of an undeclared window: "), batch)
    return enforce(rows, F.when(~known, strange))


def _leaf_dates(leaves: Iterable[str]) -> set[date]:
    """Observation dates in partition paths; unparsable periods lie in a default one."""
    texts = {leaf.rsplit("observation_date=", 1)[1] for leaf in leaves}
    return {date.fromisoformat(text) for text in texts if not text.startswith("__")}


def affected_dates(raw_batch: DataFrame) -> list[date]:
    """Distinct observation days of raw rows, on the driver: bounded by the calendar."""
    found = staging.observation_dates(raw_batch).orderBy("observation_date").collect()
    return [row["observation_date"] for row in found]


# Builds


def build_staging(
    lake: Lake, dates: Iterable[date] | None = None, batch_dates: Iterable[date] | None = None
) -> None:
    """Staged rows of the affected days, of given batch days, or of everything.

    By ``dates``, each day is rebuilt from every batch that touches it, newest ingestion
    first. By ``batch_dates``, a day's rows come from those batch days only.
    """
    # The stored observation date is the parsed period, so picking folders by it spares
    # a second parse of each row.
    if batch_dates is not None:
        batches = {"batch_date": {day.isoformat() for day in batch_dates}}
        rows = lake.stored(RAW_TABLE, batches).where(F.col(DAY).isNotNull())
        lake.replace_partitions("stg_grid_metrics", staging.newest_staged(rows))
    elif dates is not None:
        dates = list(dates)
        raw = lake.stored(RAW_TABLE, lake.book.raw_leaves(dates))
        lake.replace_partitions("stg_grid_metrics", staging.newest_staged(raw), day_leaves(dates))
    else:
        raw = lake.stored(RAW_TABLE)
        newest = staging.newest_staged(raw.where(F.col(DAY).isNotNull()))
        undated = staging.canonicalise(raw.where(F.col(DAY).isNull()))
        lake.replace("stg_grid_metrics", newest.unionByName(undated))


def build_fact(lake: Lake, dates: Iterable[date] | None = None) -> None:
    if dates is None:
        lake.replace("fct_grid_metrics", lake["stg_grid_metrics"], laid_out=True)
    else:
        dates = list(dates)
        rows, days = lake.on_days("stg_grid_metrics", dates), day_leaves(dates)
        lake.replace_partitions("fct_grid_metrics", rows, days, laid_out=True)


def merge_dimensions(lake: Lake, dates: Iterable[date] | None = None) -> None:
    """Merge the dimensions from all staged rows of the affected days, or of all days.

    The region dimension keeps the times that order its names, so a merge of some days is
    right whatever was loaded, or failed, before. A merge of all days goes by these alone.
    """
    if dates is None:
        rows, newest_by = lake["stg_grid_metrics"], None
    else:
        rows = lake.on_days("stg_grid_metrics", dates)
        newest_by = ("_ingestion_timestamp", "observation_timestamp")
    _together(
        lake.spark,
        lambda: lake.merge("dim_region", marts.newest_names(rows), ["region"], newest_by),
        lambda: lake.merge(
            "dim_energy_source", marts.dim_energy_source(rows), ["energy_source"]
        ),
    )


def build_aggregates(lake: Lake, dates: Iterable[date] | None = None) -> None:
    """The four aggregates, whole or for the affected days: each is keyed by day."""
    dates = None if dates is None else list(dates)

    def build(name: str, rows: DataFrame) -> None:
        if dates is None:
            lake.replace(name, rows)
        else:
            lake.replace_partitions(name, rows, day_leaves(dates))

    def source(name: str) -> DataFrame:
        return lake[name] if dates is None else lake.on_days(name, dates)

    fact = source("fct_grid_metrics")

    def build_ranks_after_daily() -> None:
        build("agg_load_daily", marts.load_daily(fact))
        build("agg_top_regions", marts.top_regions(source("agg_load_daily")))

    _together(
        lake.spark,
        lambda: build("agg_load_hourly", marts.load_hourly(fact)),
        lambda: build("agg_generation_mix", marts.generation_mix(fact)),
        build_ranks_after_daily,
    )


def rebuild(lake: Lake, dates: Iterable[date] | None = None) -> None:
    """All tables from raw, whole or for the affected days."""
    dates = None if dates is None else list(dates)
    with lake.book.changing(_rebuilt(dates)):
        build_staging(lake, dates)
        _build_marts(lake, dates)


def _rebuilt(dates: list[date] | None) -> dict[str, dict[str, set[str]] | None]:
    """What a rebuild of these days changes, by table."""
    tables = [name for name in MODELS if DAY in TABLES[name].partition_by]
    return {name: None if dates is None else day_leaves(dates) for name in tables}


def _build_marts(lake: Lake, dates: list[date] | None) -> None:
    def build_fact_and_aggregates() -> None:
        build_fact(lake, dates)
        build_aggregates(lake, dates)

    _together(
        lake.spark,
        build_fact_and_aggregates,
        lambda: merge_dimensions(lake, dates),
    )


def _together(spark: SparkSession, *actions: Callable[[], None]) -> None:
    """Jobs on different tables at once: one alone seldom fills a cluster."""
    with ThreadPoolExecutor(len(actions)) as pool:
        inherited = [inheritable_thread_target(spark)(action) for action in actions]
        for started in [pool.submit(action) for action in inherited]:
            started.result()


# Scoring and control rows


def score_anomalies(
    lake: Lake, dates: Iterable[date] | None, run_id: str, checked_at: datetime | None = None
) -> int:
    """Append the scores of the affected days; returns the number of rows."""
    sources = ("agg_load_daily", "agg_generation_mix")
    if dates is None:
        load, mix = (lake[name] for name in sources)
    else:
        dates = list(dates)
        if not dates:
            return 0
        wanted = with_history(dates, BASELINE_DAYS)
        load, mix = (lake.on_days(name, wanted) for name in sources)
    scored = anomalies.score(anomalies.daily_metrics(load, mix), dates)
    rows = anomalies.anomaly_rows(scored, run_id, checked_at or utc_now())
    written = Observation()
    days = None if dates is None else day_leaves(dates)
    with lake.book.changing({"anomaly_results": days}):
        lake.append("anomaly_results", rows.observe(written, F.count(F.lit(1)).alias("rows")))
    return written.get["rows"]


def newest_ingestions(lake: Lake) -> DataFrame:
    """The newest ingestion of each raw partition, as the raw table names it."""
    entries = lake.book.partitions(RAW_TABLE)
    return entries.select(F.col("newest_ingestion").alias("_ingestion_timestamp"))


def newest_observations(lake: Lake) -> DataFrame:
    entries = lake.book.partitions("stg_grid_metrics")
    return entries.select(F.col("last_observation").alias("observation_timestamp"))


def log_freshness(lake: Lake, run_id: str, checked_at: datetime | None = None) -> None:
    """Append both freshness signals; unknown values when they cannot be read."""
    checked_at = checked_at or utc_now()
    try:
        signals = control.freshness_signals(newest_ingestions(lake), newest_observations(lake))
        lake.append("freshness_log", control.freshness_row(signals, run_id, checked_at))
    except Exception:
        LOGGER.warning("freshness falls back to unknown values", exc_info=True)
        unknown = control.unknown_freshness_row(lake.spark, run_id, checked_at)
        lake.append("freshness_log", unknown)


def advance_state(
    lake: Lake, window: BatchWindow, run_id: str, updated_at: datetime | None = None
) -> None:
    """Upsert the watermark row: its partition is the key, so the write reads nothing."""
    row = control.state_row(lake.spark, window, run_id, updated_at or utc_now())
    lake.replace_partitions("pipeline_state", row)


def gate_freshness(lake: Lake, checked_at: datetime | None = None) -> str:
    """Status of the raw source; an error stops the run, a warning is logged."""
    checked = quality.source_freshness(newest_ingestions(lake), checked_at or utc_now()).first()
    if checked["status"] == "error":
        raise quality.CheckFailure(f"raw source is stale: newest {checked['max_loaded_at']}")
    if checked["status"] == "warn":
        LOGGER.warning("raw source is getting stale: newest %s", checked["max_loaded_at"])
    return checked["status"]


def run_checks(lake: Lake, dates: Iterable[date] | None = None) -> DataFrame:
    """Results of every check, over all rows or over the affected days.

    The key holds the observation time, so rows of different days never collide and
    checking the rebuilt days finds what checking the whole table would.
    """
    tables = {name: lake[name] for name in {check.table for check in quality.CHECKS}}
    if dates is not None:
        dates = list(dates)
        for name in ("stg_grid_metrics", "fct_grid_metrics"):
            tables[name] = lake.on_days(name, dates)
    return quality.check_results(tables)


def result_rows(lake: Lake, checks: list, built: bool) -> DataFrame:
    nodes = [(f"model.{name}", "success", None) for name in MODELS if built]
    nodes += [(f"test.{row['check_name']}", row["status"], None) for row in checks]
    return lake.spark.createDataFrame(
        nodes, "unique_id string, status string, bytes_processed bigint"
    )


def record_run(
    lake: Lake,
    *,
    run_id: str,
    window: BatchWindow,
    rows_loaded: int,
    results: DataFrame,
    status: str,
    started_at: datetime,
    created_at: datetime | None = None,
) -> None:
    row = control.run_metrics_row(
        control.check_totals(results),
        run_id=run_id,
        job_id=control.PIPELINE_NAME,
        execution_date=window.end,
        window=window,
        rows_loaded=rows_loaded,
        started_at=started_at,
        status=status,
        created_at=created_at or utc_now(),
    )
    lake.append("run_metrics", row)


# Whole runs


def land_window(
    lake: Lake,
    landing: str,
    window: BatchWindow,
    tagged_rows: DataFrame,
    ingested_at: datetime | None = None,
) -> DataFrame:
    """Normalise and land one window's API rows; returns them as read back."""
    stamped = stamp_batch(require_rows(tagged_rows), window, ingested_at)
    land(normalise(stamped), landing)
    return read_landed(lake.spark, landing, [window])


def run_window(
    lake: Lake,
    raw_rows: DataFrame,
    window: BatchWindow,
    run_id: str,
    *,
    replace: str = REPLACE_WINDOW,
    checked_at: datetime | None = None,
) -> Loaded:
    """Load a window, rebuild its days, check, score and record.

    A failed check or a stale source stops the run and is recorded as failed; a failed
    scoring only warns. The watermark moves on success alone.
    """
    return _run(lake, raw_rows, {run_id: window}, replace, checked_at)


def backfill(
    lake: Lake, windows: Iterable[tuple[BatchWindow, DataFrame]], run_prefix: str = "backfill"
) -> list[Loaded]:
    """Run windows in order, one run each; running them again changes no data table."""
    return [
        run_window(lake, rows, window, _run_id(run_prefix, window)) for window, rows in windows
    ]


def bulk_backfill(
    lake: Lake,
    raw_rows: DataFrame,
    windows: Iterable[BatchWindow],
    run_prefix: str = "bulk",
    *,
    checked_at: datetime | None = None,
) -> Loaded:
    """Many windows at once, by the same rules as one.

    One load, one rebuild of every affected day, one gate, one pass of checks and scores;
    each window gets its ``run_metrics`` row, and the newest stands for all in the
    freshness log, the scores and the watermark.
    """
    runs = {_run_id(run_prefix, w): w for w in sorted(windows, key=lambda w: (w.start, w.end))}
    return _run(lake, raw_rows, runs, REPLACE_WINDOW, checked_at)


def load_and_rebuild(
    lake: Lake, raw_rows: DataFrame, windows: Iterable[BatchWindow]
) -> Loaded:
    """Data tables only: no checks, scores or control rows."""
    with lake.book.together():
        loaded = load_raw(lake, raw_rows, windows)
        rebuild(lake, loaded.affected_dates)
    return loaded


def _run_id(prefix: str, window: BatchWindow) -> str:
    return f"{prefix}__{window.end.isoformat()}"


def _score(lake: Lake, dates: list[date], run_id: str, checked_at: datetime | None) -> None:
    try:
        score_anomalies(lake, dates, run_id, checked_at)
    except Exception:
        LOGGER.warning("anomaly scoring failed; the run goes on", exc_info=True)


def _run(
    lake: Lake,
    raw_rows: DataFrame,
    runs: Mapping[str, BatchWindow],
    replace: str,
    checked_at: datetime | None,
) -> Loaded:
    lake.create_missing()
    started_at = utc_now()
    run_id, window = list(runs.items())[-1]
    loaded = Loaded({}, sorted({w.batch_date for w in runs.values()}), [])
    checks: list = []
    built = False
    status = "failed"
    try:
        with lake.book.together():
            loaded = load_raw(lake, raw_rows, runs.values(), replace)
            gate_freshness(lake, checked_at)
            dates = loaded.affected_dates
            # Only a rebuild by days tells which staged days it replaces.
            by_days = replace == REPLACE_WINDOW
            changes = _rebuilt(dates) | ({} if by_days else {"stg_grid_metrics": None})
            with lake.book.changing(changes | {"anomaly_results": day_leaves(dates)}):
                if by_days:
                    build_staging(lake, dates)
                else:
                    build_staging(lake, batch_dates=loaded.batch_dates)
                _build_marts(lake, dates)
                built = True
                checks = run_checks(lake, dates).collect()
                failed = sorted(row["check_name"] for row in checks if row["status"] == "fail")
                built = not failed
                if built:
                    _score(lake, dates, run_id, checked_at)
        if failed:
            raise quality.CheckFailure(f"failed checks: {', '.join(failed)}")
        advance_state(lake, window, run_id)
        status = "success"
    finally:
        log_freshness(lake, run_id, checked_at)
        totals = control.check_totals(result_rows(lake, checks if built else [], built)).first()
        rows = control.run_metrics_rows(
            lake.spark, runs, loaded.rows_by_batch, totals, started_at, status, utc_now()
        )
        lake.append("run_metrics", rows)
    return loaded
