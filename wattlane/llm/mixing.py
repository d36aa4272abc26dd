"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target size. Its documents all want ``target / source size`` copies:
the whole part is sure, the rest is a probability. Rounding pairs two fractional
documents and moves mass between them, weighed by size, until one becomes integral; the
direction is drawn so that each document keeps its probability, and the moved mass keeps
the source's size. Each task rounds a leaf of about ``LEAF_ROWS`` documents down to one
fractional document; these residuals meet in a tree of ``FAN_IN`` leaves a node until one
is left per source, and that one is drawn. So a source misses its target by less than one
document's size, whatever the number of its documents.

Draws depend only on seed, source and documents: reruns agree.

Defined cases: a null text has size 0; a null source is a source of its own, last in
order; a document of size 0 takes no words and is drawn alone; repeated rows are documents
of their own, and so are rows of a null id; an empty table gives an empty table; other columns
are not read. Rows that agree in all that is looked at are counted, in lots of a leaf's size
at most, and a lot is rounded as one: its rows get equal shares, or differ by one copy.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlane.llm.common import WORD, kept_aside

LEAF_ROWS = 4096
FAN_IN = 64
MOST_COPIES = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    most: float = MOST_COPIES,
    alike: Column | None = None,
) -> DataFrame:
    """``source``, ``n_rows``, ``source_size`` and ``target`` of ``sizes`` (source, size), each
    row of which stands for ``alike`` documents (null: for one).

    Weights repeat over the sources in code point order, null last. Targets share the whole
    size by weight and stop at ``most`` times the source's size. Resharing what is above
    until nothing is above fills all sources to one level per weight; the level follows
    from the sources in order of ``most * size / weight``, where those below the level are
    the full ones. The windows run over one row per source, never over documents.
    """
    whole_size = F.col("size") if alike is None else F.col("size") * alike
    sources = sizes.groupBy("source").agg(
        F.count("*").alias("n_rows"), F.sum(whole_size).alias("source_size")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    cap = F.col("source_size") * float(most)
    weighed = sources.withColumn("weight", weight).withColumn("full_at", cap / F.col("weight"))
    filling = Window.orderBy("full_at", "source")
    below = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(below), F.lit(0.0))) / F.sum(
        "weight"
    ).over(onward)
    # The first source that the level does not fill sets the level for all after it.
    levels = weighed.withColumn("level", level).withColumn("open", F.col("level") < F.col("full_at"))
    reached = F.min(F.when(F.col("open"), F.struct("full_at", "source", "level"))).over(whole)
    target = F.least(cap, F.col("weight") * F.coalesce(reached["level"], F.col("full_at")))
    return levels.withColumn("target", target).select("source", "n_rows", "source_size", "target")


def pivot(
    sizes: np.ndarray, parts: np.ndarray, draws: np.ndarray
) -> tuple[np.ndarray, int | None]:
    """Round fractional ``parts`` two at a time; the index of the one left over, if any."""
    x = parts.astype(float).copy()
    held: int | None = None
    for j in range(len(x)):
        if not 0.0 < x[j] < 1.0:
            continue
        if held is None:
            held = j
            continue
        i, a, b = held, sizes[held], sizes[j]
        up = min(a * (1.0 - x[i]), b * x[j])  # mass from j to i
        down = min(a * x[i], b * (1.0 - x[j]))  # mass from i to j
        moved = up if draws[j] * (up + down) < down else -down
        x[i] = _settled(x[i] + moved / a)
        x[j] = _settled(x[j] - moved / b)
        held = j if 0.0 < x[j] < 1.0 else i if 0.0 < x[i] < 1.0 else None
    return x, held


def _settled(x: float) -> float:
    """Rounding errors of a division must not leave a settled document fractional."""
    return 0.0 if x < 1e-12 else 1.0 if x > 1.0 - 1e-12 else x


def _rounded(seed: int, level: int, last: bool):
    """Rounds one node of the tree; the residual row stays fractional below the root."""

    def node(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("order_key", "ascending"), ("size", "ascending")])
        sizes = rows["size"].to_numpy().astype(float)
        parts = rows["part"].to_numpy().astype(float)
        key = rows["order_key"].to_numpy()
        rng = np.random.default_rng([seed, level, int(key[0]) & (2**63 - 1), len(sizes)])
        draws = rng.random(len(sizes) + 1)
        x, held = pivot(sizes, parts, draws)
        if held is not None and last:
            x[held] = 1.0 if draws[-1] < x[held] else 0.0
        place = rows.schema.get_field_index("part")
        return rows.set_column(place, "part", pa.array(x, pa.float64()))

    return node


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    size: Column | None = None,
    weights: Sequence[float] = (1, 2, 3),
    keep: Sequence[str] = (),
    seed: int = 17,
    leaf_rows: int = LEAF_ROWS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Each row's ``copies`` in the mix, with ``doc_id``, ``source``, ``size``, ``source_size``,
    ``target`` and the columns named in ``keep`` (of types that group); texts do not travel."""
    size = word_count(F.col("text")) if size is None else size
    sized = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{source_col}`").alias("source"),
        size.cast("bigint").alias("size"),
        *(F.col(f"`{name}`") for name in keep),
    )
    columns = [F.col(f"`{name}`") for name in sized.columns]
    lot_numbers = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("alike") - 1) / leaf_rows))
    lots = (
        sized.groupBy(*columns)
        .agg(F.count("*").alias("alike"))
        .withColumn("lot", F.explode(lot_numbers))
        .withColumn("alike", F.least(F.lit(leaf_rows), F.col("alike") - F.col("lot") * leaf_rows))
    )
    lots = kept_aside(lots)
    targets = kept_aside(source_targets(lots, weights, alike=F.col("alike")))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    wanted = F.col("alike") * ratio
    joined = lots.join(
        targets.withColumnRenamed("source", "target_source"),
        F.col("source").eqNullSafe(F.col("target_source")),
    ).drop("target_source")
    order_key = F.xxhash64(F.lit(seed), "doc_id", "size", "lot", *(F.col(f"`{c}`") for c in keep))
    units = joined.select(
        "*",
        F.floor(wanted).alias("sure"),
        (wanted - F.floor(wanted)).alias("part"),
        order_key.alias("order_key"),
        # Leaves are counted off by source, so a large source has many of the usual size.
        F.pmod(order_key, F.greatest(F.lit(1), F.ceil(F.col("n_rows") / leaf_rows))).alias("node"),
    )
    alone = (F.col("size") == 0) | (F.col("part") <= 0)
    chance = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "lot"), F.lit(2**40)) / F.lit(2.0**40)
    drawn = chance < F.col("part")
    done = [units.where(alone).withColumn("part", drawn.cast("double"))]
    open_rows = units.where(~alone)

    most = targets.agg(F.max("n_rows")).first()[0] or 1
    levels = 1 + max(0, math.ceil(math.log(max(1, math.ceil(most / leaf_rows)), fan_in)))
    for level in range(levels):
        last = level == levels - 1
        rounded = kept_aside(
            open_rows.groupBy("source", "node").applyInArrow(
                _rounded(seed, level, last), open_rows.schema
            )
        )
        settled = F.col("part").isin(0.0, 1.0)
        done.append(rounded.where(settled))
        open_rows = rounded.where(~settled).withColumn(
            "node", F.floor(F.col("node") / fan_in).cast("bigint")
        )
    result = done[0]
    for rows in done[1:]:
        result = result.unionByName(rows)
    # A lot's copies go to its rows evenly, one more to as many as are left over.
    total = (F.col("sure") + F.col("part")).cast("bigint")
    each = F.floor(total / F.col("alike"))
    over = (total - each * F.col("alike")).cast("int")
    shares = F.concat(
        F.array_repeat(each + 1, over), F.array_repeat(each, F.col("alike").cast("int") - over)
    )
    return result.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.explode(shares).alias("copies"),
        *(F.col(f"`{name}`") for name in keep),
    )
