"""Ranks inside groups that are too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlane.session import shared_folder

#: Steps of the search for a row's range, greatest first: enough for a million ranges.
_STEPS = [1 << bit for bit in range(19, -1, -1)]


def _beside(rows: DataFrame, known: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Rows with what is known of the values in ``names``, nulls alike."""
    known = known.withColumnsRenamed({name: f"__of_{name}" for name in names})
    same = F.lit(True)
    for name in names:
        same &= F.col(name).eqNullSafe(F.col(f"__of_{name}"))
    return rows.join(known, same, how).drop(*(f"__of_{name}" for name in names))


def _range_of(place: Column, cuts: Column) -> Column:
    """How many of the ascending cuts are at or before a place, by halving."""
    return F.aggregate(
        F.array(*[F.lit(step) for step in _STEPS]),
        F.lit(0),
        lambda at, step: F.when(F.get(cuts, at + step - 1) <= place, at + step).otherwise(at),
    )


def ranked_in_ranges(
    rows: DataFrame, *, group: str, value: str, name: str, out: str = "rank", range_rows: int = 1_000_000
) -> DataFrame:
    """``rows`` with their rank within ``group`` by ``value`` descending (nulls last), then
    ``name`` (nulls first), as ``rank()`` over a window gives it; equal rows share a rank.

    Two passes in place of one task a group. Equal places are counted first, so that ties
    collapse before any shuffle. About one place in ``range_rows``, chosen by its hash, is a
    cut; places are counted between cuts, and a place's rank is what lies in the ranges
    before its own plus what lies before it there. A task orders one range. The rows are
    written once into the shared folder, so that all passes see the same values.
    """
    shared_folder(rows.sparkSession)
    rows = rows.checkpoint()
    number = F.col(value).cast("double")
    places = rows.groupBy(group, value, name).agg(F.count(F.lit(1)).alias("__n"))
    places = places.withColumn(
        # A value that is no number comes first in a descending order, as the greatest.
        "__place",
        F.struct(
            F.col(value).isNull().alias("missing"),
            (~F.coalesce(F.isnan(number), F.lit(False))).alias("ordinary"),
            F.negative(value).alias("value"),
            F.col(name).alias("name"),
        ),
    )
    cuts = (
        places.where(F.pmod(F.xxhash64(group, value, name), F.lit(range_rows)) == 0)
        .groupBy(group)
        .agg(F.sort_array(F.collect_list("__place")).alias("__cuts"))
    )
    ranged = _beside(places, cuts, [group], "left").withColumn(
        "__range",
        F.when(F.col("__cuts").isNull(), 0).otherwise(_range_of(F.col("__place"), F.col("__cuts"))),
    ).drop("__cuts")
    earlier = Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy(group, "__range").agg(F.sum("__n").alias("__size"))
    ranges = ranges.select(
        group, "__range", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before")
    )
    inside = (
        Window.partitionBy(group, "__range")
        .orderBy("__place")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counted = ranged.withColumn("__inside", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    ranks = _beside(counted, ranges, [group, "__range"]).select(
        group, value, name, (F.col("__before") + F.col("__inside") + 1).cast("long").alias(out)
    )
    return _beside(rows, ranks, [group, value, name])
