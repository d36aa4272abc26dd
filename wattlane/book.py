"""What is known of every partition: which exist, their rows and the extremes of their times.

Jobs enter a partition twice: as pending before they change it, with what it holds afterwards.
So questions of days, bounds, freshness and flags are answered from a few entries, whatever
the tables hold. A job that stops half-way leaves its partitions pending; these are read
themselves until a rerun has entered them. Writes outside a job mark what they touch, and
a lake without a book is read as it lies. The entries are a log of merged segments.

Of a partition the greatest entry counts. A load enters the batch it replaces, then the batch
and its days under one number, so days that it no longer brings are older than their
batch. A rebuild of a whole table does the same with the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlane.schemas import PARTITION_BOOK, TABLES

if TYPE_CHECKING:
    from wattlane.lake import Lake

BOOK = "partition_book"
RAW = "eia_grid_batch"

TABLE, BATCH, PARTITION = "table", "batch", "partition"

#: Tables whose partitions are entered.
BOOKED = (
    RAW,
    "stg_grid_metrics",
    "fct_grid_metrics",
    "agg_load_hourly",
    "agg_load_daily",
    "agg_generation_mix",
    "agg_top_regions",
    "anomaly_results",
)

#: Partition columns by which a change is entered; a batch stands for all its days.
BOOKED_BY = {
    name: tuple(key for key in TABLES[name].partition_by if name != RAW or key != "observation_date")
    for name in BOOKED
}

# Partition column to wanted values, as they are spelt in folder names; None: the whole table.
Leaves = Mapping[str, set[str]] | None


@dataclass(frozen=True)
class Pending:
    """The number that a table's entries must have reached, and what is not known of it."""

    since: int
    whole: bool
    leaves: dict[str, set[str]]

    @property
    def nothing(self) -> bool:
        return not self.whole and not self.leaves


def _told(name: str, leaves: Leaves) -> Leaves:
    """The leaves, or None where they do not name what the table is entered by."""
    return leaves if leaves is not None and set(BOOKED_BY[name]) <= leaves.keys() else None


def measures(name: str) -> dict[str, Column]:
    """Columns of an entry that are counted off the rows; the others are NULL."""
    columns = TABLES[name].stored.fieldNames()
    found = {"n_rows": F.count(F.lit(1))}
    if "_ingestion_timestamp" in columns:
        found["newest_ingestion"] = F.max("_ingestion_timestamp")
    if "observation_timestamp" in columns:
        found["first_observation"] = F.min("observation_timestamp")
        found["last_observation"] = F.max("observation_timestamp")
    if name == "anomaly_results":
        flagged = F.when(F.col("anomaly_flag"), F.col("region"))
        found["newest_check"] = F.max("checked_at")
        found["n_flagged"] = F.count_if("anomaly_flag")
        # As many as there are regions.
        found["flagged_regions"] = F.sort_array(F.collect_set(flagged))
    return found


def _entry(name: str, scope: str, columns: Mapping[str, Column]) -> list[Column]:
    known = {"table_name": F.lit(name), "scope": F.lit(scope), **columns}
    return [
        known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PARTITION_BOOK.fields
    ]


def measured(lake: Lake, name: str, leaves: Leaves, number: int = 0) -> DataFrame:
    """Entries of the partitions as they lie."""
    keys = TABLES[name].partition_by
    counted = lake.stored(name, leaves).groupBy(*keys)
    values = measures(name)
    found = counted.agg(*[value.alias(column) for column, value in values.items()])
    columns = {column: F.col(column) for column in (*keys, *values)}
    return found.select(
        *_entry(name, PARTITION, columns | {"entry": F.lit(number), "pending": F.lit(False)})
    )


class Book:
    def __init__(self, lake: Lake) -> None:
        self.lake = lake
        self._open: set[str] = set()
        self._held: list[tuple[list[tuple], Mapping[str, Leaves]]] = []
        self._depth = 0
        self._state: tuple[list, dict[str, Pending]] = ([], {})

    def exists(self) -> bool:
        return self.lake.exists(BOOK)

    # Entering

    @contextmanager
    def together(self) -> Iterator[None]:
        """What is known after a change waits for the next entry, or for the end."""
        self._depth += 1
        try:
            yield
        finally:
            self._depth -= 1
            if not self._depth and self._held:
                self._write([])

    @contextmanager
    def changing(self, changes: Mapping[str, Leaves]) -> Iterator[None]:
        """Partitions that the body changes, by table; entered when it ends well."""
        new = not self.exists()
        changes = {n: _told(n, leaves) for n, leaves in changes.items() if n not in self._open}
        if not changes:
            yield
            return
        if new:  # nothing is known yet, so there is nothing to take back
            changes = {n: None if self.lake.exists(n) else x for n, x in changes.items()}
        else:
            self._write(self._marks(changes, pending=True))
        self._open |= changes.keys()
        try:
            yield
        finally:
            self._open -= changes.keys()
        self._held.append((self._marks(changes, pending=False), changes))
        if not self._depth:
            self._write([])

    def touch(self, name: str, leaves: Leaves) -> None:
        """A write outside a job: what it touches is not known any more."""
        if name in BOOKED and name not in self._open and self.exists():
            self._write(self._marks({name: _told(name, leaves)}, pending=True))

    def renew(self, names: Iterable[str] = BOOKED) -> None:
        """Enter whole tables as they lie, for a lake whose book was lost or never begun."""
        with self.changing({name: None for name in names if self.lake.exists(name)}):
            pass

    def _marks(self, changes: Mapping[str, Leaves], pending: bool) -> list[tuple]:
        """Scope and keys of what is entered, apart from what is counted."""
        marks = []
        for name, leaves in changes.items():
            if leaves is None:
                marks.append((name, TABLE, None, None, None, pending))
            elif name == RAW:
                batches = [(d, b) for d in leaves["batch_date"] for b in leaves["_batch_id"]]
                marks += [(name, BATCH, date.fromisoformat(d), b, None, pending) for d, b in batches]
            else:
                days = map(date.fromisoformat, leaves["observation_date"])
                marks += [(name, PARTITION, None, None, day, pending) for day in days]
        return marks

    def _write(self, marks: list[tuple]) -> None:
        """One append of what is held back and of these marks, which come after it."""
        held, self._held = self._held, []
        known = {name: leaves for _, changes in held for name, leaves in changes.items()}
        known = {n: x for n, x in known.items() if n not in {mark[0] for mark in marks}}
        marks = [m for own, _ in held for m in own if m[0] in known] + marks
        if not self.exists():  # a book that begins beside tables does not know them
            beside = [n for n in BOOKED if n not in known and self.lake.exists(n)]
            marks += self._marks(dict.fromkeys(beside), pending=True)
        if not marks:
            return
        log = self.lake.segments(BOOK)
        number = log.next_number()
        rows = self.lake.spark.createDataFrame(
            marks,
            "table_name string, scope string, batch_date date, _batch_id string, "
            "observation_date date, pending boolean",
        )
        columns = {c: F.col(c) for c in rows.columns[2:]} | {"entry": F.lit(number)}
        entries = rows.select(
            F.col("table_name"), F.col("scope"), *_entry("", "", columns | {"n_rows": F.lit(0)})[2:]
        )
        frames = [measured(self.lake, name, leaves, number) for name, leaves in known.items()]
        if frames:
            # A day that is still there takes the place of its mark.
            entries = reduce(DataFrame.unionByName, frames, entries)
            keys = TABLES[BOOK].keys
            rest = [c for c in PARTITION_BOOK.fieldNames() if c not in keys]
            most = F.max_by(F.struct(*rest), F.col("n_rows")).alias("most")
            entries = entries.groupBy(*keys).agg(most).select(*keys, "most.*")
        log.append(entries.select(*PARTITION_BOOK.fieldNames()))

    # Asking

    def pending(self, name: str) -> Pending:
        """Read off the log once for each state of it: segments never change."""
        if not self.exists():
            return Pending(0, True, {})
        segments = self.lake.segments(BOOK).segments()
        if self._state[0] != segments:
            self._state = (segments, self._pending(self.lake.stored(BOOK)))
        return self._state[1].get(name, Pending(0, False, {}))

    @staticmethod
    def _pending(log: DataFrame) -> dict[str, Pending]:
        # Days are only told for days: a batch's days share its number.
        day = F.when(F.col("scope") == PARTITION, F.col("observation_date"))
        part = F.when(F.col("table_name") != RAW, day)
        last = log.groupBy(
            "table_name", (F.col("scope") == TABLE).alias("whole"), "batch_date", "_batch_id", part.alias("day")
        ).agg(F.max("entry").alias("entry"), F.max_by("pending", F.struct("entry", "pending")).alias("pending"))
        found: dict[str, Pending] = {}
        rows = last.where(F.col("whole") | F.col("pending")).collect()
        for row in sorted(rows, key=lambda r: not r["whole"]):
            now = found.setdefault(row["table_name"], Pending(0, False, {}))
            if row["whole"]:
                found[row["table_name"]] = Pending(row["entry"], row["pending"], {})
            elif row["entry"] >= now.since:
                values = {"batch_date": row["batch_date"], "_batch_id": row["_batch_id"], "observation_date": row["day"]}
                for key, value in values.items():
                    if value is not None:
                        now.leaves.setdefault(key, set()).add(str(value))
        return found

    def known(self, name: str) -> DataFrame:
        """Entries of the partitions that are there and not pending."""
        since = self.pending(name).since
        log = self.lake.stored(BOOK).where(
            (F.col("table_name") == name) & (F.col("scope") != TABLE) & (F.col("entry") >= since)
        )
        keys = ["batch_date", "_batch_id"] if name == RAW else ["observation_date"]
        last = F.max("entry").over(Window.partitionBy(*keys))
        live = log.withColumn("last", last).where(F.col("entry") == F.col("last")).drop("last")
        return live.where((F.col("scope") == PARTITION) & ~F.col("pending") & (F.col("n_rows") > 0))

    def partitions(self, name: str) -> DataFrame:
        """Entries of all partitions of a table. Only pending ones are read themselves."""
        state = self.pending(name)
        if state.whole:
            return measured(self.lake, name, None)
        known = self.known(name)
        if state.nothing:
            return known
        return known.unionByName(measured(self.lake, name, state.leaves))

    def raw_leaves(self, days: Iterable[date]) -> dict[str, set[str]]:
        """Folders that may hold raw rows of some days: those of the batches that touch them."""
        days = list(days)
        texts = {day.isoformat() for day in days}
        state = self.pending(RAW)
        if state.whole or not days:
            return {"observation_date": texts}
        touching = self.known(RAW).where(F.col("observation_date").isin(*days))
        batches = touching.select("batch_date", "_batch_id").distinct().collect()
        found = {"batch_date": {str(row["batch_date"]) for row in batches}, "_batch_id": {row["_batch_id"] for row in batches}}
        for key, values in state.leaves.items():
            found[key] |= values
        return found | {"observation_date": texts}

    def batches_of(self, batch_dates: Iterable[date], ids: set[str]) -> Leaves:
        """Batches of these dates that are entered, and those named; None if not all are known."""
        dates = list(batch_dates)
        state = self.pending(RAW)
        if state.whole or state.leaves:
            return None
        held = self.known(RAW).where(F.col("batch_date").isin(*dates))
        found = {row["_batch_id"] for row in held.select("_batch_id").distinct().collect()}
        return {"batch_date": {day.isoformat() for day in dates}, "_batch_id": found | ids}
