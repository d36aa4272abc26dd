"""Data checks: each names the rows (or groups) that break a rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.functions.metrics import FUEL_CODES, METRIC_NAMES
from wattlane.functions.status import age_micros, source_status
from wattlane.lake import union_all

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Check:
    """``kind`` is not_null, accepted, unique or reference."""

    table: str
    kind: str
    columns: tuple[str, ...]
    values: tuple[str, ...] = field(default=())
    parent: str = ""

    @property
    def name(self) -> str:
        return f"{self.table}.{self.kind}.{'-'.join(self.columns)}"

    @property
    def per_row(self) -> bool:
        return self.kind in ("not_null", "accepted")

    def broken(self) -> Column:
        """The row condition of a per-row check; NULL passes ``accepted``."""
        column = F.col(self.columns[0])
        if self.kind == "not_null":
            return column.isNull()
        return column.isNotNull() & ~column.isin(*self.values)


def _not_null(table: str, *columns: str) -> list[Check]:
    return [Check(table, "not_null", (column,)) for column in columns]


KEY = "metric_surrogate_key"

CHECKS: tuple[Check, ...] = (
    *_not_null(
        "stg_grid_metrics", KEY, "region", "observation_timestamp", "metric_name", "metric_value"
    ),
    Check("stg_grid_metrics", "unique", (KEY,)),
    Check("stg_grid_metrics", "accepted", ("metric_name",), METRIC_NAMES),
    Check("stg_grid_metrics", "accepted", ("energy_source",), FUEL_CODES),
    *_not_null(
        "fct_grid_metrics",
        KEY,
        "region",
        "observation_timestamp",
        "observation_date",
        "metric_name",
        "metric_value",
    ),
    Check("fct_grid_metrics", "unique", (KEY,)),
    Check(
        "fct_grid_metrics",
        "unique",
        ("region", "observation_timestamp", "metric_name", "energy_source"),
    ),
    Check("fct_grid_metrics", "reference", ("region",), parent="dim_region"),
    Check("fct_grid_metrics", "reference", ("energy_source",), parent="dim_energy_source"),
    *_not_null("dim_region", "region"),
    Check("dim_region", "unique", ("region",)),
    *_not_null("dim_energy_source", "energy_source"),
    Check("dim_energy_source", "unique", ("energy_source",)),
)


def violations(tables: Tables, check: Check) -> DataFrame:
    """The broken rows; for ``unique`` the repeated keys with their counts.

    A single-column uniqueness ignores NULLs, a column combination groups them together.
    References are compared once per distinct value, so neither side is broadcast and a
    value that fills much of the table meets the parent as one row.
    """
    rows = tables[check.table]
    if check.per_row:
        return rows.where(check.broken())
    columns = list(check.columns)
    if check.kind == "unique":
        if len(columns) == 1:
            rows = rows.where(F.col(columns[0]).isNotNull())
        counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
        return counted.where(F.col("n_rows") > 1)
    parent = tables[check.parent].select(*columns)
    held = rows.where(F.col(columns[0]).isNotNull())
    counted = held.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.join(parent, columns, "left_anti")


def _result(name: Column, n_broken: Column) -> list[Column]:
    return [
        name.alias("check_name"),
        n_broken.cast("long").alias("n_broken"),
        F.when(n_broken > 0, "fail").otherwise("pass").alias("status"),
    ]


def _table_results(tables: Tables, table: str, checks: Sequence[Check]) -> list[DataFrame]:
    """Per-row checks in one aggregate without keys, which tasks combine before anything is
    shuffled; every other check shuffles the counts of its own columns alone."""
    frames = []
    per_row = [(i, check) for i, check in enumerate(checks) if check.per_row]
    if per_row:
        sums = tables[table].agg(*[F.count_if(check.broken()).alias(str(i)) for i, check in per_row])
        pairs = [
            F.struct(F.lit(check.name).alias("name"), F.col(str(i)).alias("n"))
            for i, check in per_row
        ]
        frames.append(
            sums.select(F.explode(F.array(*pairs)).alias("pair")).select(
                *_result(F.col("pair.name"), F.col("pair.n"))
            )
        )
    for check in checks:
        if check.per_row:
            continue
        n = F.count(F.lit(1)) if check.kind == "unique" else F.coalesce(F.sum("n_rows"), F.lit(0))
        broken = violations(tables, check).agg(n.alias("n"))
        frames.append(broken.select(*_result(F.lit(check.name), F.col("n"))))
    return frames


def check_results(tables: Tables, checks: Sequence[Check] = CHECKS) -> DataFrame:
    """One row per check: name, broken rows or groups, pass or fail."""
    frames = []
    for table in dict.fromkeys(check.table for check in checks):
        frames += _table_results(tables, table, [c for c in checks if c.table == table])
    return union_all(frames)


class CheckFailure(RuntimeError):
    """A check that stops the run."""


def source_freshness(raw: DataFrame, checked_at: datetime) -> DataFrame:
    """Age of the newest ingestion with its pass, warn or error status."""
    checked = F.lit(checked_at)
    return raw.agg(F.max("_ingestion_timestamp").alias("max_loaded_at")).select(
        "max_loaded_at",
        (age_micros(F.col("max_loaded_at"), checked) / F.lit(1_000_000)).alias("age_seconds"),
        source_status(F.col("max_loaded_at"), checked).alias("status"),
    )
