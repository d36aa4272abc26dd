"""Named parquet tables under one root: routing, reads and the write modes jobs need."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.book import BOOKED, BOOKED_BY, Book
from wattlane.schemas import TABLES, Table
from wattlane.segments import Segments
from wattlane.session import prepare, prepare_folders

# Partition column to wanted values, as they are spelt in folder names.
Leaves = Mapping[str, set[str]]

DATASETS = ("raw", "staging", "marts", "meta")
CONTROL_TABLES = ("pipeline_state", "run_metrics", "freshness_log", "anomaly_results")


class SchemaDrift(RuntimeError):
    """A write whose columns or types differ from the table's."""


class Lake:
    """Tables by name. ``lake["agg_load_daily"]`` is a DataFrame in contract column order.

    ``sample=True`` routes every dataset to its ``_sample`` twin; ``datasets`` renames
    single datasets.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        *,
        sample: bool = False,
        datasets: Mapping[str, str] | None = None,
    ) -> None:
        self.spark = prepare_folders(prepare(spark))
        self.root = root.rstrip("/")
        suffix = "_sample" if sample else ""
        self.datasets = {name: f"{name}{suffix}" for name in DATASETS} | dict(datasets or {})
        self.book = Book(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{self.datasets[TABLES[name].dataset]}/{name}"

    def __getitem__(self, name: str) -> DataFrame:
        return self.stored(name).select(*TABLES[name].schema.fieldNames())

    def stored(self, name: str, leaves: Leaves | None = None) -> DataFrame:
        """The table with its layout-only columns; empty while nothing was written.

        ``leaves`` names wanted partition values as text. Only their folders are listed,
        where a filter would first list the whole table.
        """
        schema = TABLES[name].stored
        if TABLES[name].segmented:
            return self.segments(name).read().select(*schema.fieldNames())
        if leaves is not None and not all(leaves.values()):
            return self.spark.createDataFrame([], schema)
        if leaves is None:
            path = self._live_path(name)
        else:
            path = self._pattern(name, leaves)
        folder, files = self._folder(path)
        if not (files.globStatus(folder) or ()):
            return self.spark.createDataFrame([], schema)
        # A pattern's folders are read as partitions of the table they lie in.
        root = path if leaves is None else self.path(name)
        reader = self.spark.read.schema(schema).option("basePath", root)
        return reader.parquet(path).select(*schema.fieldNames())

    def segments(self, name: str) -> Segments:
        table = TABLES[name]
        return Segments(
            self.spark, self.path(name), table.stored,
            newest_by=table.newest_by, keys=table.keys, sort_by=table.sort_by,
        )

    def newest(self, name: str) -> DataFrame:
        """The rows of a log's newest segment, which has its newest row: one file is read."""
        return self.segments(name).newest().select(*TABLES[name].schema.fieldNames())

    def on_days(self, name: str, dates: Iterable[date]) -> DataFrame:
        """The table's rows of some observation days."""
        return self.stored(name, day_leaves(dates)).select(*TABLES[name].schema.fieldNames())

    def _pattern(self, name: str, leaves: Leaves) -> str:
        levels = [
            f"{key}={{{','.join(sorted(leaves[key]))}}}" if key in leaves else f"{key}=*"
            for key in TABLES[name].partition_by
        ]
        return "/".join([self.path(name), *levels])

    def exists(self, name: str) -> bool:
        folder, files = self._folder(self.path(name))
        return files.exists(folder)

    def _folder(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def create_missing(self, names: Iterable[str] = CONTROL_TABLES) -> None:
        for name in names:
            if TABLES[name].segmented:
                self.segments(name).create()
            elif not self.exists(name):
                self.replace(name, self.spark.createDataFrame([], TABLES[name].stored))

    def sql(self, query: str, **parameters: object) -> DataFrame:
        """A query over the lake's tables, with bound named parameters."""
        for name in TABLES:
            if name in query:
                self[name].createOrReplaceTempView(name)
        return self.spark.sql(query, args=parameters)

    def replace(self, name: str, rows: DataFrame, *, laid_out: bool = False) -> None:
        """Rebuild a whole table."""
        if TABLES[name].segmented:
            check_schema(name, rows)
            self.segments(name).replace(rows)
            return
        self.book.touch(name, None)
        self._writer(name, rows, laid_out).mode("overwrite").parquet(self.path(name))

    def append(self, name: str, rows: DataFrame) -> None:
        if TABLES[name].segmented:
            check_schema(name, rows)
            self.segments(name).append(rows)
            return
        self.book.touch(name, None)
        self._writer(name, rows).mode("append").parquet(self.path(name))

    def replace_partitions(
        self,
        name: str,
        rows: DataFrame,
        leaves: Leaves | None = None,
        *,
        laid_out: bool = False,
    ) -> list[str]:
        """Overwrite the partitions that ``rows`` holds; return the ones dropped.

        ``leaves`` names the partitions that the rows stand for. One of them that got no
        new rows is dropped: an overwrite by partition cannot see it, but its old files
        are still listed afterwards.
        """
        self.book.touch(name, leaves)
        if not self.exists(name):
            # Nothing to replace: Spark moves folders as they are, without a look at each.
            self._writer(name, rows, laid_out).mode("append").parquet(self.path(name))
            return []
        before = self.files(name, leaves) if leaves is not None else set()
        (
            self._writer(name, rows, laid_out)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .parquet(self.path(name))
        )
        untouched = before & self.files(name, leaves) if before else set()
        stale = sorted({file.rsplit("/", 1)[0] for file in untouched})
        for leaf in stale:
            folder, files = self._folder(f"{self.path(name)}/{leaf}")
            files.delete(folder, True)
        return stale

    def files(self, name: str, leaves: Leaves) -> set[str]:
        """Data files of some partitions, below the table's path; a listing only."""
        depth = len(TABLES[name].partition_by) + 1
        found = self.stored(name, leaves).inputFiles()
        return {"/".join(file.split("/")[-depth:]) for file in found}

    def merge(
        self, name: str, rows: DataFrame, keys: list[str], newest_by: Iterable[str] | None = None
    ) -> None:
        """Update or insert by key into a small unpartitioned table, never delete.

        With ``newest_by``, a key keeps the row that is greatest in these columns, whether
        it is stored or given; without, the given one.

        A path cannot be overwritten while it is read: the merged rows are written beside
        the table and then moved into its place. Until they are, reads find one or the
        other, and a merge that was cut short is finished by the next.
        """
        self._move_into_place(name)
        schema = TABLES[name].stored.fieldNames()
        stored, rows = self.stored(name), rows.select(*schema)
        if newest_by is None:
            merged = stored.join(rows, keys, "left_anti").select(*schema).unionByName(rows)
        else:
            order = [*newest_by]
            rest = [column for column in schema if column not in (*keys, *order)]
            newest = F.max(F.struct(*order, *rest)).alias("newest")
            merged = stored.unionByName(rows).groupBy(*keys).agg(newest)
            merged = merged.select(*keys, "newest.*").select(*schema)
        self._writer(name, merged).mode("overwrite").parquet(self._beside(name))
        folder, files = self._folder(self.path(name))
        files.delete(folder, True)
        self._move_into_place(name)

    def _beside(self, name: str) -> str:
        return f"{self.path(name)}__merged"

    def _live_path(self, name: str) -> str:
        """The table's path, or the complete merge about to be moved there."""
        done, files = self._folder(f"{self._beside(name)}/_SUCCESS")
        waiting = not self.exists(name) and files.exists(done)
        return self._beside(name) if waiting else self.path(name)

    def _move_into_place(self, name: str) -> None:
        if self._live_path(name) != self.path(name):
            beside, files = self._folder(self._beside(name))
            files.rename(beside, self._folder(self.path(name))[0])

    def set_column(self, name: str, where: Column, column: str, value: Column) -> None:
        """Update one column in the rows that ``where`` selects; all others stay.

        Only the partitions that hold a selected row are read again and rewritten.
        """
        keys = TABLES[name].partition_by
        if not keys or column in keys:
            raise ValueError(f"{name}.{column} cannot be updated by partition")
        names = TABLES[name].stored.fieldNames()
        rows = self.stored(name)
        touched = rows.where(where).select(*[F.col(key).alias(f"touched_{key}") for key in keys])
        same = [F.col(key).eqNullSafe(F.col(f"touched_{key}")) for key in keys]
        whole = rows.join(touched.distinct(), same, "left_semi")
        changed = whole.withColumn(column, F.when(where, value).otherwise(F.col(column)))
        if name not in BOOKED:
            self.replace_partitions(name, changed.select(*names))
            return
        # As many rows as there are partitions to rewrite.
        found = touched.distinct().collect()
        told = BOOKED_BY[name]
        leaves = {key: {str(row[f"touched_{key}"]) for row in found} for key in told}
        with self.book.changing({name: leaves if all(None not in row for row in found) else None}):
            self.replace_partitions(name, changed.select(*names))

    def copy_batch(self, target: Lake, batch_date: date) -> None:
        """Rebuild the target's raw table from one batch date of this lake."""
        rows = self.stored("eia_grid_batch").where(F.col("batch_date") == F.lit(batch_date))
        target.replace("eia_grid_batch", rows)

    def _writer(self, name: str, rows: DataFrame, laid_out: bool = False):
        """``laid_out`` rows come from files that already lie by the same partitions."""
        table = TABLES[name]
        check_schema(name, rows)
        if not table.partition_by:
            return rows.write
        # Rebalancing by partition keeps files few, yet splits a day (or batch) that
        # holds most of the rows over several tasks.
        if not laid_out:
            rows = rows.hint("rebalance", *[F.col(key) for key in table.partition_by])
        ordered = rows.sortWithinPartitions(*table.partition_by, *table.sort_by)
        return ordered.write.partitionBy(*table.partition_by)


def day_leaves(dates: Iterable[date]) -> dict[str, set[str]]:
    return {"observation_date": {day.isoformat() for day in dates}}


def check_schema(name: str, rows: DataFrame) -> None:
    """Refuse to write columns or types the table does not have."""
    expected = [(field.name, field.dataType) for field in TABLES[name].stored.fields]
    actual = [(field.name, field.dataType) for field in rows.schema.fields]
    if actual != expected:
        changed = [field for field in actual if field not in expected]
        missing = [field for field in expected if field not in actual]
        raise SchemaDrift(f"{name}: unexpected {changed}, missing {missing}")


def missing_required(table: Table) -> Column:
    """Names of required columns that are NULL in a row, as one text; empty when none."""
    names = [F.when(F.col(name).isNull(), F.lit(name)) for name in table.required]
    return F.concat_ws(", ", *names)


def enforce(rows: DataFrame, problem: Column) -> DataFrame:
    """Fail the job on the first row whose ``problem`` text is set.

    The check is a filter, so it costs no second pass and is never pruned away.
    """
    return rows.where(
        F.when(problem.isNull() | (problem == ""), F.lit(True)).otherwise(
            F.raise_error(problem).cast("boolean")
        )
    )


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), frames)
