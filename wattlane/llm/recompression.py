"""Substring dedup by recompression: words under windows that an earlier document has.

Each text's words are named by hashes, and rounds rename them: a run of one name becomes
one name, then each pair of a left and a right name, sides told by a bit of the name,
becomes one. Names depend on content alone, so all tasks name alike without asking each
other, and equal word sequences get equal names but near their ends, where neighbours
outside decide. How far that reaches is kept with every name as its context: two texts
with the same words in a context hold the same name there.

A window of ``WINDOW`` words is filed under one symbol: among the names of the last round
whose context lies inside the window, the least in a fixed random order, leftmost of
equals; where there is none, likewise among the places where the word changes; a window of
one repeated word under that word. Equal windows are filed at the same place in them under
the same key, the hash of the symbol's context, so shared symbols reveal all repeats.
Windows next to each other mostly share a symbol; such a stretch is one row.

Verification goes from coarse to fine. Stretches equal as a whole (64 bits mixed from two
hashes over all their words) form a class: every member beyond the smallest id is covered. Only where
a key has unlike classes are windows compared one by one, and there only those of each
class's smallest document.

Defined cases: a null text is empty; a document with a null id, like one of fewer words
than a window, loses nothing and takes nothing from others; documents of one id take
nothing from each other; rows that repeat id and text get the same answer; an empty table
gives an empty table; other columns are not read. No key is capped: a key with more than
``IN_ONE_TASK`` classes is settled window by window in groupings that combine before
their shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import kept_aside, texts_of
from wattlane.llm.textarrays import BASE, BASES, ODD, RangeHashes, blocks, mixed

WINDOW = 50
ROUNDS = 3


def _renamed(
    names: np.ndarray, left: np.ndarray, right: np.ndarray, salt: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One round over names and their contexts [left, right)."""
    # Runs: whether one ends is told by the names beside it.
    first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    length = np.diff(np.concatenate([first, [len(names)]]))
    last = first + length - 1
    far = np.concatenate([[left[0] - 1], left])  # beyond the ends nothing is known
    near = np.concatenate([right, [right[-1] + 1]])
    left, right = far[first], near[last + 1]
    named = mixed(names[first] + length.astype(np.uint64) * ODD + np.uint64(salt))
    names = np.where(length > 1, named, names[first])
    # Pairs: a left name asks the next one only, a right name the one before only.
    is_left = (mixed(names ^ np.uint64(salt * 7919 + 1)) & np.uint64(1)).astype(bool)
    opens = np.concatenate([is_left[:-1] & ~is_left[1:], [False]])
    closes = np.concatenate([[False], opens[:-1]])
    far = np.concatenate([[left[0] - 1], left[:-1]])
    near = np.concatenate([right[1:], [right[-1] + 1]])
    new_left = np.where(is_left, left, far)
    new_right = np.where(is_left, near, right)
    pair = mixed(names[:-1] * BASE + mixed(names[1:] + np.uint64(salt)))
    new_names = names.copy()
    new_names[:-1][opens[:-1]] = pair[opens[:-1]]
    keep = ~closes
    return new_names[keep], new_left[keep], new_right[keep]


def _least_in_windows(
    order: np.ndarray, left: np.ndarray, right: np.ndarray, starts: np.ndarray, n: int, width: int
) -> np.ndarray:
    """For each window start the candidate [left, right) inside it of least order, or -1."""
    inside = (left >= 0) & (right <= n)
    place = np.flatnonzero(inside)
    order, left, right = order[inside], left[inside], right[inside]
    out = np.full(len(starts), -1, np.int64)
    if not len(place) or not len(starts):
        return out
    begun = np.concatenate([[0], np.cumsum(np.bincount(left, minlength=n + 1))])
    ended = np.cumsum(np.bincount(right, minlength=n + 1))
    low, high = begun[starts], ended[starts + width]
    some = np.flatnonzero(high > low)
    low, high = low[some], high[some]
    # Ranks tell all candidates apart: of equal orders the leftmost comes first.
    ranked = np.argsort(order, kind="stable")
    keys = np.empty(len(order), np.int64)
    keys[ranked] = np.arange(len(order))
    reach = np.floor(np.log2(high - low)).astype(np.int64) if len(some) else low
    best = np.empty(len(some), np.int64)
    table = keys
    for k in range(int(reach.max(initial=0)) + 1):
        if k:
            table = np.minimum(table[: -(1 << (k - 1))], table[1 << (k - 1) :])
        here = reach == k
        best[here] = np.minimum(table[low[here]], table[high[here] - (1 << k)])
    out[some] = place[ranked[best]]
    return out


def stretches(names: np.ndarray, bounds: np.ndarray, width: int = WINDOW, rounds: int = ROUNDS):
    """Stretches of windows filed under one symbol, for word names of texts in a row.

    ``bounds`` has where each text's words begin and the last end; between texts stands a
    name of its own, so contexts never reach across unseen. Yields text, key, class, the
    first and last window start (within the text) of each stretch.
    """
    n_texts = len(bounds) - 1
    size = np.diff(bounds)
    at = bounds[:-1] + np.arange(n_texts)  # one name more before each text
    n = len(names) + n_texts
    wall = at
    full = np.empty(n, np.uint64)
    is_wall = np.zeros(n, bool)
    is_wall[wall] = True
    full[~is_wall] = names
    full[wall] = mixed(np.arange(n_texts).astype(np.uint64) + np.uint64(1 << 50))
    begin = wall + 1
    n_windows = np.maximum(size - width + 1, 0)
    text = np.repeat(np.arange(n_texts), n_windows)
    starts = np.repeat(begin - np.cumsum(n_windows) + n_windows, n_windows) + np.arange(len(text))
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return empty, empty.astype(np.uint64), empty.astype(np.uint64), empty, empty

    symbol, left, right = full, np.arange(n), np.arange(1, n + 1)
    for salt in range(1, rounds + 1):
        symbol, left, right = _renamed(symbol, left, right, salt)
    chosen = _least_in_windows(mixed(symbol + np.uint64(99)), left, right, starts, n, width)
    found = chosen >= 0
    a, b = left[chosen], right[chosen]
    rest = np.flatnonzero(~found)
    if len(rest):
        change = np.flatnonzero(full[1:] != full[:-1])  # between a word and the next
        pair = mixed(full[change] * BASE + full[change + 1])
        some = _least_in_windows(pair, change, change + 2, starts[rest], n, width)
        a[rest] = np.where(some >= 0, change[some], -1)
        b[rest] = np.where(some >= 0, change[some] + 2, -1)
    same = a < 0
    edge = np.ones(len(starts), bool)
    edge[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(edge)
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    low, high, a, b, same, text = starts[first], starts[last], a[first], b[first], same[first], text[first]
    one, two = RangeHashes(full), RangeHashes(full, BASES[1])
    # A stretch of one repeated word is as good as its first window.
    end = np.where(same, low, high) + width
    a, b = np.where(same, low, a), np.where(same, low + 1, b)
    key = one(a, b) ^ same.astype(np.uint64)
    cls = mixed(one(low, end) ^ mixed(two(low, end) + (a - low).astype(np.uint64)))
    shift = begin[text]
    return text, key, cls, low - shift, high - shift


def _together(text, key, cls, low, high):
    """Equal stretches of one text as one row with all their first starts: words that
    repeat in a period have as many of them as words."""
    span = high - low
    order = np.lexsort((low, span, cls, key, text))
    text, key, cls, span, low = (x[order] for x in (text, key, cls, span, low))
    new = np.ones(len(order), bool)
    new[1:] = (
        (text[1:] != text[:-1]) | (key[1:] != key[:-1])
        | (cls[1:] != cls[:-1]) | (span[1:] != span[:-1])
    )
    first = np.flatnonzero(new)
    ends = pa.array(np.concatenate([first, [len(order)]]), pa.int32())
    lows = pa.ListArray.from_arrays(ends, pa.array(low.astype(np.int32)))
    return text[first], key[first], cls[first], span[first], lows


def _filed(width: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, block in blocks(batch["text"]):
                starts, ends, bounds = block.words()
                names = block.word_hashes(starts, ends)
                found = stretches(names, bounds, width, rounds)
                text, key, cls, span, lows = _together(*found)
                rows = pa.array(at + text)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].take(rows),
                        batch["text_key"].take(rows),
                        pa.array(key.view(np.int64)),
                        pa.array(cls.view(np.int64)),
                        lows,
                        pa.array(span.astype(np.int32)),
                    ],
                    names=["doc_id", "text_key", "key", "cls", "lows", "span"],
                )

    return run


def _spelled(width: int):
    """Hashes of the windows in each text's ``parts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch["parts"].to_pylist()
            for at, block in blocks(batch["text"]):
                starts, ends, bounds = block.words()
                names = block.word_hashes(starts, ends)
                one, two = RangeHashes(names), RangeHashes(names, BASES[1])
                first, text = [], []
                for k in range(block.n):
                    for part in parts[at + k]:
                        here = np.array(part["lows"])[:, None] + np.arange(part["span"] + 1)
                        first.append(here.ravel())
                        text.append(np.full(here.size, k))
                if not first:
                    continue
                start, text = np.concatenate(first), np.concatenate(text)
                begin = start + bounds[text]
                rows = pa.array(at + text)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].take(rows),
                        batch["text_key"].take(rows),
                        pa.array(start.astype(np.int32)),
                        pa.array(one(begin, begin + width).view(np.int64)),
                        pa.array(two(begin, begin + width).view(np.int64)),
                    ],
                    names=["doc_id", "text_key", "low", "a", "b"],
                )

    return run


def _beside_texts(texts: DataFrame, parts: DataFrame, how: str) -> DataFrame:
    """Texts with the ``parts`` of their documents.

    Both joins with texts go by the same columns, never null, of the same rows, so that
    Spark shuffles the texts once and reads that shuffle again.
    """

    def named(rows: DataFrame) -> DataFrame:
        return rows.withColumns(
            {
                "id_text": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                "id_null": F.col("doc_id").isNull(),
            }
        )

    keys = ["id_text", "id_null", "text_key"]
    return named(texts).join(named(parts).drop("doc_id"), keys, how)


def repeated_windows(texts: DataFrame, *, width: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id``, ``text_key``, ``lows``, ``span``: windows whose words also start in a document
    of a smaller id, ``span`` + 1 of them from each of ``lows``. ``texts`` is ``texts_of``
    some documents."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    place = f"doc_id {kind}, text_key bigint"
    told = texts.where(F.col("doc_id").isNotNull())
    filed = told.select("doc_id", "text_key", "text").mapInArrow(
        _filed(width, rounds), f"{place}, key bigint, cls bigint, lows array<int>, span int"
    )
    shared_keys = (
        filed.groupBy("key")
        .agg(
            (F.min("cls") != F.max("cls")).alias("unlike"),
            F.min("doc_id").alias("first"),
            F.max("doc_id").alias("last"),
        )
        .where(F.col("first") < F.col("last"))
        .drop("last")
    )
    shared = kept_aside(filed.join(shared_keys, "key"))
    span = ["doc_id", "text_key", "lows", "span"]
    covered = shared.where(~F.col("unlike") & (F.col("doc_id") > F.col("first"))).select(*span)

    unlike = shared.where("unlike").drop("first", "unlike")
    firsts = unlike.groupBy("key", "cls").agg(F.min("doc_id").alias("first"))
    classed = unlike.join(firsts, ["key", "cls"])
    covered = covered.unionByName(classed.where(F.col("doc_id") > F.col("first")).select(*span))

    asked = (
        classed.where(F.col("doc_id") == F.col("first"))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list(F.struct("lows", "span")).alias("parts"))
    )
    spelled = (
        _beside_texts(texts, asked, "inner")
        .select("doc_id", "text_key", "text", "parts")
        .mapInArrow(_spelled(width), f"{place}, low int, a bigint, b bigint")
    )
    least = spelled.groupBy("a", "b").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
    )
    least = least.where(F.col("first") < F.col("last")).drop("last")
    found = spelled.join(least, ["a", "b"]).where(F.col("doc_id") > F.col("first"))
    return covered.unionByName(
        found.select("doc_id", "text_key", F.array("low").alias("lows"), F.lit(0).alias("span"))
    )


def _left_over(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch["parts"].to_pylist()
            n_words, n_removed, kept_texts = [], [], []
            for text, spans in zip(batch["text"].to_pylist(), parts, strict=True):
                words = text.encode().split()  # bytes: ASCII white space alone
                gone = np.zeros(len(words) + 1, np.int64)
                for span in spans or ():
                    lows = np.array(span["lows"])
                    np.add.at(gone, lows, 1)
                    np.add.at(gone, lows + (span["span"] + width), -1)
                left = np.cumsum(gone[:-1]) == 0
                n_words.append(len(words))
                n_removed.append(int(len(words) - left.sum()))
                kept = words if n_removed[-1] == 0 else [words[i] for i in np.flatnonzero(left)]
                kept_texts.append(b" ".join(kept).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["text_key"],
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept_texts, pa.string()),
                ],
                names=["doc_id", "text_key", "n_words", "n_removed", "kept_text"],
            )

    return run


def dedup_substrings(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WINDOW,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Per row ``doc_id``, ``text_key``, ``n_words``, ``n_removed`` and ``kept_text``, the
    words left, joined by one space."""
    texts = texts_of(docs, id_col, text_col)
    gone = (
        repeated_windows(texts, width=width, rounds=rounds)
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list(F.struct("lows", "span")).alias("parts"))
    )
    kind = texts.schema["doc_id"].dataType.simpleString()
    return (
        _beside_texts(texts, gone, "left")
        .select("doc_id", "text_key", "text", "parts")
        .mapInArrow(
            _left_over(width),
            f"doc_id {kind}, text_key bigint, n_words bigint, n_removed bigint, kept_text string",
        )
    )
