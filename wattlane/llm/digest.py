"""Improbable-feature digests of texts, and their likeness.

Features are the 64-byte windows of a text's UTF-8 bytes. A window's entropy, in a
thousand steps, has a rank: the rarer that entropy among all windows of the corpus, the
lower. In each run of 64 windows the first of lowest rank is a point; windows that are a
point for many runs are the text's selected features. Their hashes set five bits each in a
Bloom filter of 2048 bits; after 160 features a new filter of the chain begins. Likeness of
two chains: for each filter of the shorter one the best overlap of bits with a filter of
the other, less what chance gives, as a share of the most possible; the mean of these.

Ranks come from counts over all documents (``entropy_ranks``) and are part of a digest's
meaning: digests made with unlike ranks do not compare.

Defined cases: a null text is empty; an empty text has an empty digest, like only to
empty ones; a text shorter than a window is one feature; where no window is a point often
enough, all points are selected; equal texts have equal digests, and likeness 1; repeated
rows are rows of their own; an empty table gives an empty table; other columns are not
read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.llm.textarrays import mixed

WINDOW = 64
LEVELS = 1000
LEAST_POPULAR = 16
FILTER_BITS = 2048
FILTER_FEATURES = 160
HASHES = 5
#: Bytes that are compared with their neighbours at once: what a core's cache holds.
TILE = 1 << 16
#: Bytes of texts digested together.
TOGETHER = 1 << 19
STRETCH_ROWS = 4096
MOST_CUTS = 2000

_SHARES = np.arange(WINDOW + 1) / WINDOW
#: A window's entropy is the sum of these over its bytes' counts; whole numbers add exactly.
_PARTS = np.concatenate([[0.0], -_SHARES[1:] * np.log2(_SHARES[1:])])
_SCALE = 2**30
_LEVEL_PARTS = np.round(_PARTS / np.log2(WINDOW) * _SCALE).astype(np.int64)


def _levels(data: np.ndarray) -> np.ndarray:
    """Entropy level (0 to ``LEVELS``) of the window at each position but the last 63.

    A window's entropy follows from the one before by the byte that leaves and the byte
    that comes; the counts these need are equal bytes among the 63 neighbours.
    """
    n = len(data)
    back = np.zeros(n, np.uint8)  # equal bytes among the 63 before
    ahead = np.zeros(n, np.uint8)
    for d in range(1, WINDOW):
        same = data[d:] == data[:-d]
        back[d:] += same
        ahead[:-d] += same
    counts = np.bincount(data[:WINDOW], minlength=256)
    first = int(_LEVEL_PARTS[counts].sum())
    gain = _LEVEL_PARTS[back[WINDOW:].astype(np.int64) + 1] - _LEVEL_PARTS[back[WINDOW:]]
    # The byte that leaves is not yet gone when the new one comes: its equal counts once less.
    loss = _LEVEL_PARTS[ahead[: n - WINDOW].astype(np.int64) + 1] - _LEVEL_PARTS[ahead[: n - WINDOW]]
    total = first + np.concatenate([[0], np.cumsum(gain - loss)])
    return np.clip(total * LEVELS // _SCALE, 0, LEVELS)


def levels(data: np.ndarray) -> np.ndarray:
    """Levels of all whole windows, tile by tile."""
    last = len(data) - WINDOW
    if last < 0:
        return np.zeros(0, np.int64)
    parts = [
        _levels(data[at : min(at + TILE, last + 1) + WINDOW - 1]) for at in range(0, last + 1, TILE)
    ]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _least_places(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest key of every ``width`` neighbours, a power of two."""
    step = 1
    while step < width:
        keys = np.minimum(keys[:-step], keys[step:])
        step *= 2
    return keys


def _selected(ranks: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the selected features of texts in a row, and whose they are.

    ``ranks`` has a rank for each place; a place or run counts where it ends in its text.
    """
    size = np.diff(bounds)
    keys = ranks << 32 | np.arange(len(ranks))
    places, owners = [], []
    if len(keys) >= WINDOW:
        points = _least_places(keys, WINDOW) & ((1 << 32) - 1)
        runs = np.maximum(size - 2 * WINDOW + 2, 0)
        owner = np.repeat(np.arange(len(size)), runs)
        start = np.repeat(bounds[:-1] - np.cumsum(runs) + runs, runs) + np.arange(len(owner))
        points = points[start]
        edge = np.flatnonzero(
            np.concatenate([[True], (points[1:] != points[:-1]) | (owner[1:] != owner[:-1])])
        ) if len(points) else np.zeros(0, np.int64)
        popular = np.diff(np.concatenate([edge, [len(points)]])) >= least
        points, owner = points[edge], owner[edge]
        some = np.bincount(owner[popular], minlength=len(size)) > 0
        chosen = popular | ~some[owner]
        places.append(points[chosen])
        owners.append(owner[chosen])
    for text in np.flatnonzero((size >= WINDOW) & (size < 2 * WINDOW - 1)):
        last = bounds[text + 1] - WINDOW + 1
        places.append(np.array([bounds[text] + ranks[bounds[text] : last].argmin()]))
        owners.append(np.array([text]))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    every, owner = np.concatenate(places), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return every[order], owner[order]


def _feature_hashes(raw: bytes, places: np.ndarray) -> np.ndarray:
    lanes = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))
    found = np.full(len(places), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(0, WINDOW, 8):
        found = mixed(found ^ lanes[places + k])
    return found


def _joined(texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray]]:
    """Texts in a row, some at a time, and where each begins and the last ends."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < TOGETHER):
            size += len(texts[end])
            end += 1
        part = texts[at:end]
        yield b"".join(part), np.concatenate([[0], np.cumsum([len(t) for t in part], dtype=np.int64)])
        at = end


def _chains(raw: bytes, bounds: np.ndarray, ranks: np.ndarray, least: int) -> list[np.ndarray]:
    level = levels(np.frombuffer(raw, np.uint8))
    rank = np.concatenate([ranks[level], np.full(len(raw) - len(level), LEVELS, np.int64)])
    places, owner = _selected(rank, bounds, least)
    hashes = _feature_hashes(raw, places) if len(places) else np.zeros(0, np.uint64)
    # Texts shorter than a window are one feature each.
    size = np.diff(bounds)
    short = np.flatnonzero((size > 0) & (size < WINDOW))
    if len(short):
        alone = [raw[bounds[i] : bounds[i + 1]] for i in short]
        own = [np.frombuffer(hashlib.sha256(x).digest()[:8], "<u8") for x in alone]
        hashes = np.concatenate([hashes, *own])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
    count = np.bincount(owner, minlength=len(size))
    filters = -(-count // FILTER_FEATURES)
    first = np.cumsum(filters) - filters
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    link = first[owner] + number // FILTER_FEATURES
    bits = np.zeros((int(filters.sum()), FILTER_BITS), bool)
    for k in range(HASHES):
        bits[link, (hashes >> np.uint64(11 * k) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits, axis=1)
    return [packed[f : f + n] for f, n in zip(first.tolist(), filters.tolist(), strict=True)]


def chains(texts: list[bytes], ranks: np.ndarray, least: int = LEAST_POPULAR) -> list[np.ndarray]:
    """Each text's chain of filters, a row each of ``FILTER_BITS`` / 8 bytes."""
    made: list[np.ndarray] = []
    for raw, bounds in _joined(texts):
        made += _chains(raw, bounds, ranks, least)
    return made


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """0 for no more in common than chance, 1 for equal chains."""
    if not len(one) or not len(other):
        return 1.0 if len(one) == len(other) else 0.0
    if one.shape == other.shape and (one == other).all():
        return 1.0
    if len(one) > len(other):
        one, other = other, one
    size = np.bitwise_count(one).sum(axis=1, dtype=np.int64)
    other_size = np.bitwise_count(other).sum(axis=1, dtype=np.int64)
    scores = []
    for filter_, own in zip(one, size, strict=True):
        shared = np.bitwise_count(filter_ & other).sum(axis=1, dtype=np.int64)
        chance = own * other_size / FILTER_BITS
        most = np.minimum(own, other_size)
        score = (shared - chance) / np.maximum(most - chance, 1e-9)
        scores.append(float(np.clip(score, 0, 1).max()))
    return float(np.mean(scores))


def as_text(chain: np.ndarray) -> str:
    return f"{len(chain)}:" + base64.b64encode(chain.tobytes()).decode()


def from_text(written: str) -> np.ndarray:
    raw = base64.b64decode(written.partition(":")[2])
    return np.frombuffer(raw, np.uint8).reshape(-1, FILTER_BITS // 8)


def entropy_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Rank of each entropy level by its rarity among all windows of all documents.

    Tasks send one row of counts each; what reaches the driver has a row per level. Levels
    that never occur rank last, as do those of windows of almost one byte only.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS + 1, np.int64)
        for batch in batches:
            for raw, bounds in _joined([(x or "").encode() for x in batch["text"].to_pylist()]):
                level = levels(np.frombuffer(raw, np.uint8))
                inside = np.repeat(bounds[1:], np.diff(bounds))[: len(level)]
                whole = np.arange(len(level)) + WINDOW <= inside
                total += np.bincount(level[whole], minlength=LEVELS + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(LEVELS + 1)), pa.array(total)], names=["level", "n"]
        )

    rows = (
        docs.select(F.col(f"`{text_col}`").alias("text"))
        .mapInArrow(counted, "level bigint, n bigint")
        .groupBy("level")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros(LEVELS + 1, np.int64)
    for row in rows:
        counts[row["level"]] = row["n"]
    weak = np.arange(LEVELS + 1) < LEVELS // 10
    order = np.lexsort((np.arange(LEVELS + 1), counts, (counts == 0) | weak))
    ranks = np.empty(LEVELS + 1, np.int64)
    ranks[order] = np.arange(LEVELS + 1)
    return ranks


def digests(docs: DataFrame, ranks: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every text. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(x or "").encode() for x in batch["text"].to_pylist()]
            made = [as_text(chain) for chain in chains(texts, ranks)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(made, pa.string())], names=["doc_id", "fingerprint"]
            )

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, fingerprint string")


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(ranks: np.ndarray):
    """Rows come by stretch, ids descending; a stretch ends with rows lent by the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the last row: id, text, whether lent, stretch, chain
        for batch in batches:
            columns = [batch[n].to_pylist() for n in ("doc_id", "text", "lent", "stretch")]
            made = chains([text.encode() for text in columns[1]], ranks)
            rows = held + list(zip(*columns, made, strict=True))
            pairs = [
                (one, two)
                for one, two in zip(rows[:-1], rows[1:], strict=True)
                if not one[2] and one[3] == two[3]
            ]
            changed = [_edited(one[1], two[1]) for one, two in pairs]
            edited = chains([text.encode() for text in changed], ranks)
            out = [
                (
                    one[0],
                    len(one[1]),
                    hashlib.sha256(text.encode()).hexdigest(),
                    as_text(one[4]),
                    as_text(chain),
                    likeness(one[4], chain),
                    likeness(one[4], two[4]),
                )
                for (one, two), text, chain in zip(pairs, changed, edited, strict=True)
            ]
            held = rows[-1:]
            yield _pair_batch(out, batch.schema.field("doc_id"))

    return run


_PAIR = (
    "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _pair_batch(rows: list[tuple], id_field: pa.Field) -> pa.RecordBatch:
    kinds = [id_field.type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", *(x.split()[0] for x in _PAIR.split(", "))]
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names
    )


def against_next(
    docs: DataFrame,
    ranks: np.ndarray,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    stretch_rows: int = STRETCH_ROWS,
) -> DataFrame:
    """Each document's digest beside those of its edited text and of the next document.

    Documents follow each other by descending number id, nulls last, equal ids by a hash
    of the text; the first follows the last. Their order is cut into stretches at quantiles
    of the ids, ``MOST_CUTS`` at most, and each stretch is lent the rows that begin the
    next one. So one shuffle brings neighbours together, and no task sorts all.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    n_ids = rows.agg(F.count("doc_id")).first()[0]
    n_cuts = min(MOST_CUTS, n_ids // stretch_rows)
    cuts: list[int] = []
    if n_cuts:
        shares = [k / (n_cuts + 1) for k in range(1, n_cuts + 1)]
        found = rows.approxQuantile("doc_id", shares, 0.1 / (n_cuts + 1))
        cuts = sorted({int(cut) for cut in found})
    # Stretch 0 holds the greatest ids; null ids are the last stretch.
    above = F.lit(0)
    if cuts:
        listed = F.array(*(F.lit(cut).cast("bigint") for cut in cuts))
        above = F.size(F.filter(listed, lambda cut: cut > F.col("doc_id")))
    number = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(above)
    text_key = F.xxhash64("text")
    firsts = {
        row["stretch"]: row["first"]
        for row in rows.groupBy(number.alias("stretch")).agg(F.max("doc_id").alias("first")).collect()
    }
    if not firsts:
        return rows.mapInArrow(_compared(ranks), _fields(rows))
    order = sorted(firsts)
    null_key = None
    if len(cuts) + 1 in firsts:
        null_key = rows.where(F.col("doc_id").isNull()).agg(F.max(text_key)).first()[0]
    # Looked up by the stretch's number, so the plan is as deep for any number of stretches.
    before = {stretch: order[at - 1] for at, stretch in enumerate(order)}
    numbers = range(len(cuts) + 2)
    place = number.cast("int") + 1
    first = F.element_at(F.array(*(F.lit(firsts.get(n)).cast("bigint") for n in numbers)), place)
    lends = F.element_at(F.array(*(F.lit(before.get(n)).cast("int") for n in numbers)), place)
    begins = F.when(
        F.col("doc_id").isNull(), text_key == F.lit(null_key).cast("bigint")
    ).otherwise(F.col("doc_id") == first)
    lent_to = F.when(begins, lends)
    own = F.struct(number.cast("int").alias("stretch"), F.lit(False).alias("lent"))
    lent = F.struct(lent_to.alias("stretch"), F.lit(True).alias("lent"))
    placed = (
        rows.select("doc_id", "text", F.explode(F.array(own, lent)).alias("place"))
        .select("doc_id", "text", "place.stretch", "place.lent")
        .where(F.col("stretch").isNotNull())
    )
    return (
        placed.repartition(max(2, len(order)), "stretch")
        .sortWithinPartitions(
            "stretch", "lent", F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc()
        )
        .mapInArrow(_compared(ranks), _fields(rows))
    )


def _fields(rows: DataFrame) -> str:
    return f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {_PAIR}"
