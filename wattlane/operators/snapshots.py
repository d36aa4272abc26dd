"""Whole-row snapshots for comparing reruns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snapshot(rows: DataFrame) -> DataFrame:
    """Each row as JSON text with its NULLs, in text order."""
    text = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return rows.select(text.alias("row_json")).orderBy("row_json")


def differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, duplicates counted; empty when equal."""
    lost = before.exceptAll(after).withColumn("side", F.lit("before"))
    gained = after.exceptAll(before).withColumn("side", F.lit("after"))
    return lost.unionByName(gained)


def fingerprints(rows: DataFrame, by: str) -> DataFrame:
    """Per value of ``by``, its rows' number and two sums of their hashes: the same in any order
    of the rows, another one where a row is repeated. Sums combine before they are shuffled."""
    values = [F.col(f"`{name}`") for name in rows.columns]
    # A hash passes over NULLs, so where they stand is hashed too.
    marks = [value.isNull() for value in values]

    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), *values, *marks).cast("decimal(38,0)"))

    return rows.groupBy(F.col(by).alias("part")).agg(
        F.count(F.lit(1)).alias("n_rows"), total(1).alias("a"), total(2).alias("b")
    )


def unlike_partitions(before: DataFrame, after: DataFrame, by: str) -> list:
    """Values of ``by``, NULL among them, whose rows differ: as many as there are partitions."""
    found = fingerprints(before, by).withColumn("side", F.lit(0))
    found = found.unionByName(fingerprints(after, by).withColumn("side", F.lit(1)))
    told = F.countDistinct("n_rows", "a", "b") + 2 - F.count(F.lit(1))
    unlike = found.groupBy("part").agg(told.alias("told")).where(F.col("told") != 1)
    return [row["part"] for row in unlike.collect()]


def partition_differences(before: DataFrame, after: DataFrame, by: str) -> DataFrame:
    """``differences``, reading rows only of the partitions whose fingerprints differ."""
    parts = unlike_partitions(before, after, by)
    chosen = F.col(by).isin(*[part for part in parts if part is not None])
    if None in parts:
        chosen = chosen | F.col(by).isNull()
    return differences(before.where(chosen), after.where(chosen))
