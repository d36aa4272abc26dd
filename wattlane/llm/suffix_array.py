"""Substring dedup on bytes: maximal repeats from the interval tree of a sparse suffix array.

Every window of ``WINDOW`` bytes has an anchor: among its ``GRAM``-byte grams the least by
hash, leftmost of equals. Equal windows have their anchors at the same place, so suffixes
that begin at anchors suffice, one in some 170. Windows next to each other that share an
anchor are one stretch; its bytes left and right of the anchor are all that can repeat.

Stretches are filed under their gram. Equal stretches (64 bits of hash) form a class, and
where a gram has one class only, all is known. Where it has more, one stretch of each class
goes on with its bytes: Spark sorts these by gram and by what stands right of the anchor,
which is the suffix array; common prefixes of neighbours make it an enhanced one. A stack
scan gives its intervals of common prefixes. Inside an interval the same is done leftwards,
over what stands left of the anchor: an interval of common left parts whose members cannot
all be extended by one more byte on either side is a maximal repeat, and all its members
are occurrences, not just neighbours. Repeats of a window's length and more cover bytes.

A gram with more than ``IN_ONE_TASK`` classes does not go to one task. It is split first by
more of the bytes that equal windows share, in rounds of groupings that combine before
their shuffle, until every group fits a task. Stretches that read alike over all windows of
a round's group are a class again, of which one goes on.

Defined cases: a null text is empty; matches never cross documents; every row is a
document, so rows repeated as they are repeat each other; a text repeats itself where its
windows do; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import kept_aside, same_document, texts_of
from wattlane.llm.textarrays import BASES, Block, blocks, byte_hashes, gram_hashes, mixed

WINDOW = 400
GRAM = 64
IN_ONE_TASK = 256


def _least_places(keys: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` keys the place of the least, the leftmost of equals."""
    place = np.arange(len(keys))

    def lesser(step: int) -> None:
        nonlocal keys, place
        n = len(keys) - step
        place = np.where(keys[step:] < keys[:n], place[step:], place[:n])
        keys = np.minimum(keys[:n], keys[step:])

    step = 1
    while step * 2 <= width:
        lesser(step)
        step *= 2
    if width > step:
        lesser(width - step)
    return place


def stretches(block: Block, width: int = WINDOW, gram: int = GRAM):
    """Text, key, class, first and last window start and anchor (all within the text)."""
    size = np.diff(block.bounds) - 1
    n_windows = np.maximum(size - width + 1, 0)
    text = np.repeat(np.arange(block.n), n_windows)
    if not len(text):
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none, none
    starts = np.repeat(block.bounds[:-1] - np.cumsum(n_windows) + n_windows, n_windows)
    starts = starts + np.arange(len(text))
    hashes = gram_hashes(block.data, gram)
    anchor = _least_places(hashes, width - gram + 1)[starts]
    edge = np.ones(len(text), bool)
    edge[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(edge)
    last = np.concatenate([first[1:], [len(text)]]) - 1
    low, high, anchor, text = starts[first], starts[last], anchor[first], text[first]
    key = hashes[anchor]
    end = high + width
    one, two = (byte_hashes(block.data, low, end, base) for base in BASES)
    cls = mixed(one ^ mixed(two + (anchor - low).astype(np.uint64)))
    shift = block.bounds[text]
    return text, key, cls, low - shift, high - shift, anchor - shift


def _once(text, key, cls, low, high, anchor):
    """Equal stretches of one text: the first of each goes on, and the starts of all of
    them, merged, are repeats already."""
    order = np.lexsort((low, cls, key, text))
    t, k, c = text[order], key[order], cls[order]
    same = (t[1:] == t[:-1]) & (k[1:] == k[:-1]) & (c[1:] == c[:-1])
    first = np.concatenate([[True], ~same]) if len(order) else np.zeros(0, bool)
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    own = np.sort(order[again])
    spans = [np.zeros(0, np.int64)] * 3
    if len(own):
        gap = np.ones(len(own), bool)
        gap[1:] = (text[own[1:]] != text[own[:-1]]) | (low[own[1:]] > high[own[:-1]] + 1)
        at = np.flatnonzero(gap)
        ends = np.concatenate([at[1:], [len(own)]]) - 1
        spans = [text[own[at]], low[own[at]], high[own[ends]]]
    chosen = np.sort(order[first])
    return chosen, spans


def _filed(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, block in blocks(batch["text"]):
                text, key, cls, low, high, anchor = stretches(block, width, gram)
                chosen, (own, own_low, own_high) = _once(text, key, cls, low, high, anchor)
                rows = pa.array(at + np.concatenate([text[chosen], own]))
                none = pa.nulls(len(own), pa.int64())
                # Spans of repeats inside a text have no class; any key will do for them.
                spread = batch["text_key"].take(pa.array(at + own))

                def filled(values: np.ndarray, rest: pa.Array) -> pa.Array:
                    return pa.concat_arrays([pa.array(values.view(np.int64)), rest])

                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].take(rows),
                        batch["text_key"].take(rows),
                        filled(key[chosen], spread),
                        filled(cls[chosen], none),
                        pa.array(np.concatenate([low[chosen], own_low]).astype(np.int32)),
                        pa.array(np.concatenate([high[chosen], own_high]).astype(np.int32)),
                        filled(anchor[chosen], none).cast(pa.int32()),
                    ],
                    names=["doc_id", "text_key", "key", "cls", "low", "high", "anchor"],
                )

    return run


def _spelled(width: int):
    """The bytes of asked stretches, left part reversed, right part from the anchor on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()  # of rows repeated as they are, one is enough
        for batch in batches:
            anchors, crowded, keys, left, right, rows = [], [], [], [], [], []
            columns = [batch[n].to_pylist() for n in ("doc_id", "text_key", "text", "parts")]
            for row, (doc_id, text_key, text, parts) in enumerate(zip(*columns, strict=True)):
                if (doc_id, text_key) in seen:
                    continue
                seen.add((doc_id, text_key))
                raw = text.encode()
                for part in parts:
                    low, high, anchor = part["low"], part["high"], part["anchor"]
                    rows.append(row)
                    anchors.append(anchor)
                    crowded.append(part["crowded"])
                    keys.append(part["key"])
                    left.append(raw[low:anchor][::-1])
                    right.append(raw[anchor : high + width])
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(at),
                    batch["text_key"].take(at),
                    pa.array(keys, pa.int64()),
                    pa.array(crowded, pa.bool_()),
                    pa.array(anchors, pa.int32()),
                    pa.array(left, pa.binary()),
                    pa.array(right, pa.binary()),
                ],
                names=["doc_id", "text_key", "key", "crowded", "anchor", "left", "right"],
            )

    return run


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    high = min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    low = 0
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def intervals(prefixes: list[int]) -> Iterator[tuple[int, int, int]]:
    """Depth, first and last member of each common-prefix interval, children first.

    ``prefixes[i]`` is what members i and i + 1 share; a stack holds the open intervals.
    """
    stack: list[tuple[int, int]] = []
    for i, shared in enumerate([*prefixes, -1]):
        begin = i
        while stack and stack[-1][0] > shared:
            depth, begin = stack.pop()
            yield depth, begin, i
        if not stack or stack[-1][0] < shared:
            stack.append((shared, begin))


def maximal_repeats(
    left: list[bytes], right: list[bytes], width: int
) -> Iterator[tuple[int, int, list[int]]]:
    """Left and right reach from the anchor, and all members, of each maximal repeat of at
    least ``width`` bytes. ``right`` is ascending; members of one class come once."""
    prefixes = [common(a, b) for a, b in zip(right[:-1], right[1:], strict=True)]
    for depth, begin, end in intervals(prefixes):
        if depth <= 0:
            continue
        members = sorted(range(begin, end + 1), key=left.__getitem__)
        shared = [common(left[a], left[b]) for a, b in zip(members[:-1], members[1:], strict=True)]
        for reach, first, last in intervals(shared):
            if reach + depth < width:
                continue
            group = members[first : last + 1]
            # Diverse to the left by its interval; to the right unless a deeper interval,
            # which came before, holds all of it.
            inner = sorted(group)
            if min(prefixes[inner[0] : inner[-1]]) > depth:
                continue
            yield reach, depth, group


def _repeats(width: int, merged: bool):
    """Occurrences of repeats, or what they cover of each stretch, merged; stretches come
    sorted by key and right part."""

    def settle(group: list[tuple]) -> Iterator[tuple]:
        if len(group) < 2:
            return
        left, right = [g[4] for g in group], [g[5] for g in group]
        covers: list[list[tuple[int, int]]] = [[] for _ in group]
        for number, (reach, depth, members) in enumerate(maximal_repeats(left, right, width)):
            for m in members:
                doc_id, text_key, key, anchor, _, _ = group[m]
                low, high = anchor - reach, anchor + depth - width
                if merged:
                    covers[m].append((low, high))
                else:
                    yield doc_id, text_key, key, number, low, high
        for (doc_id, text_key, key, *_), spans in zip(group, covers, strict=True):
            end = None
            for low, high in sorted(spans):
                if end is not None and low <= end + 1:
                    end = max(end, high)
                    continue
                if end is not None:
                    yield doc_id, text_key, key, None, begin, end
                begin, end = low, high
            if end is not None:
                yield doc_id, text_key, key, None, begin, end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            out: list[tuple] = []
            for row in zip(*(batch[i].to_pylist() for i in range(6)), strict=True):
                if held and held[0][2] != row[2]:
                    out.extend(settle(held))
                    held = []
                held.append(row)
            yield _occurrence_batch(out, kind)
        if held:
            yield _occurrence_batch(list(settle(held)), kind)

    return run


def _occurrence_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
        names=["doc_id", "text_key", "key", "number", "low", "high"],
    )


def _split(nodes: DataFrame, width: int) -> DataFrame:
    """Halves of each node's reaches, for stretches that have windows in them.

    A node stands for the windows that begin ``p`` to ``q`` bytes before the anchor. All of
    them hold the ``p`` bytes left of it and ``width - q`` from it on: the node's core. A
    stretch goes on with the bytes that its windows in the half hold together, no others.
    """
    halves = F.expr(
        "array(named_struct('p', p, 'q', (p + q) div 2), "
        "named_struct('p', (p + q) div 2 + 1, 'q', q))"
    )
    return (
        nodes.withColumn("half", F.explode(halves))
        .withColumns({"p": F.col("half.p").cast("int"), "q": F.col("half.q").cast("int")})
        .drop("half")
        .where(F.expr(f"length(left) >= p and length(right) >= {width} - q"))
        .withColumns(
            {
                "left": F.expr("substring(left, 1, q)"),
                "right": F.expr(f"substring(right, 1, {width} - p)"),
                "core": F.expr(
                    f"md5(concat(substring(left, 1, p), substring(right, 1, {width} - q)))"
                ),
            }
        )
        .withColumn("whole", F.expr("md5(concat(hex(length(left)), ':', left, right))"))
    )


def _uncrowded(crowded: DataFrame, width: int, gram: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Crowded grams split by more and more of the bytes that equal windows share.

    Returns stretches in groups of ``most`` at most (``key`` names the group), and windows
    that several stretches have alike. The reaches of a gram's windows are halved, round by
    round. In a half, stretches of one core can have equal windows. Those that read alike over
    the whole half have them all: they are told as they are, and one of them goes on for the
    others, if others of its core read otherwise. So what goes on are the unlike readings: a
    change inside the core leaves the group, one outside the half no longer tells stretches
    apart, and as halves shrink few changes are left in between. Nothing is left out.
    """
    columns = crowded.columns
    nodes = crowded.withColumns({"p": F.lit(0), "q": F.lit(width - gram)})
    fitting = crowded.limit(0)
    equal = crowded.limit(0).select(
        "doc_id", "text_key", "key", F.lit(0).alias("low"), F.lit(0).alias("high")
    )
    group = ["key", "p", "q", "core"]
    one = F.struct("doc_id", "text_key", "anchor", "left", "right")
    while not nodes.isEmpty():
        halves = kept_aside(_split(nodes, width))
        readings = kept_aside(
            halves.groupBy(*group, "whole").agg(F.count("*").alias("n"), F.min(one).alias("one"))
        )
        several = readings.where(F.col("n") > 1).select(*group, "whole")
        equal = equal.unionByName(
            halves.join(several, [*group, "whole"], "left_semi").select(
                "doc_id",
                "text_key",
                F.xxhash64(*group, "whole").alias("key"),
                (F.col("anchor") - F.length("left")).alias("low"),
                (F.col("anchor") + F.length("right") - width).alias("high"),
            )
        )
        sizes = readings.groupBy(*group).agg(F.count("*").alias("unlike")).where("unlike > 1")
        onward = kept_aside(
            readings.join(sizes, group).select(*group, "unlike", "one.*")
        )
        fits = F.col("unlike") <= most
        fitting = fitting.unionByName(
            onward.where(fits).withColumn("key", F.xxhash64(*group)).select(*columns)
        )
        nodes = onward.where(~fits).select(*columns, "p", "q")
    return fitting, equal


def repeat_groups(
    texts: DataFrame,
    *,
    width: int = WINDOW,
    gram: int = GRAM,
    in_one_task: int = IN_ONE_TASK,
    merged: bool = False,
) -> DataFrame:
    """Occurrences of repeats in ``texts`` (``texts_of`` some documents): ``doc_id``,
    ``text_key``, ``key`` and ``number`` of the repeat, and ``low`` and ``high``, first and
    last window start inside it (so its length is ``high - low + width``).

    A repeat that runs on over several stretches is reported in each; a class with several
    members is a repeat of its own (number null) and has one member in those of its key.
    ``merged`` gives what the repeats of a stretch cover, in place of each occurrence: nested
    repeats have many, a stretch is covered but once.
    """
    kind = texts.schema["doc_id"].dataType.simpleString()
    place = f"doc_id {kind}, text_key bigint"
    filed = texts.mapInArrow(
        _filed(width, gram), f"{place}, key bigint, cls bigint, low int, high int, anchor int"
    )
    number = F.lit(None).cast("int").alias("number")
    span = ["doc_id", "text_key", "key", number, "low", "high"]
    keys = (
        filed.where(F.col("cls").isNotNull())
        .groupBy("key")
        .agg(F.count("*").alias("n"), (F.min("cls") != F.max("cls")).alias("unlike"))
        .where(F.col("n") > 1)
        .select("key", "unlike")
    )
    alone = F.col("cls").isNull()  # spans of repeats inside one text
    shared = kept_aside(
        filed.join(keys, "key", "left")
        .where(alone | F.col("unlike").isNotNull())
        .withColumn("unlike", F.when(alone, False).otherwise(F.col("unlike")))
    )
    found = shared.where(~F.col("unlike")).select(*span)

    unlike = shared.where("unlike").drop("unlike")
    member = F.struct("doc_id", "text_key", "low", "high", "anchor")
    classes = kept_aside(
        unlike.groupBy("key", "cls").agg(F.count("*").alias("n"), F.min(member).alias("member"))
    )
    several = classes.where(F.col("n") > 1).select("key", "cls")
    found = found.unionByName(unlike.join(several, ["key", "cls"]).select(*span))

    sizes = classes.groupBy("key").agg((F.count("*") > in_one_task).alias("crowded"))
    asked = (
        classes.join(sizes, "key")
        .select("key", "cls", "crowded", "member.*")
        .groupBy("doc_id", "text_key")
        .agg(
            F.collect_list(
                F.struct("key", "cls", "crowded", "low", "high", "anchor")
            ).alias("parts")
        )
    )
    spelled = kept_aside(
        texts.join(asked, same_document(texts, asked))
        .select(texts["doc_id"], texts["text_key"], "text", "parts")
        .mapInArrow(
            _spelled(width),
            f"{place}, key bigint, crowded boolean, anchor int, left binary, right binary",
        )
    )
    fitting, equal = _uncrowded(
        spelled.where("crowded").drop("crowded"), width, gram, in_one_task
    )
    repeats = (
        spelled.where(~F.col("crowded"))
        .drop("crowded")
        .unionByName(fitting)
        .repartition("key")
        .sortWithinPartitions("key", "right")
        .mapInArrow(_repeats(width, merged), f"{place}, key bigint, number int, low int, high int")
    )
    return found.unionByName(repeats).unionByName(equal.select(*span))


def _left_over(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_removed, n_spans, kept_bytes = [], [], [], []
            for text, spans in zip(batch["text"].to_pylist(), batch["parts"].to_pylist(), strict=True):
                raw = text.encode()
                n_bytes.append(len(raw))
                kept, at, removed, runs = [], 0, 0, 0
                end = -1
                for low, high in sorted((s["low"], s["high"] + width) for s in spans or ()):
                    if low > end:
                        runs += 1
                        if end >= 0:
                            removed += end - at
                        kept.append(raw[max(end, 0) : low])
                        at = low
                    end = max(end, high)
                if end >= 0:
                    removed += end - at
                kept.append(raw[max(end, 0) :])
                n_removed.append(removed)
                n_spans.append(runs)
                kept_bytes.append(b"".join(kept))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["text_key"],
                    pa.array(n_bytes, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(n_spans, pa.int64()),
                    pa.array(kept_bytes, pa.binary()),
                ],
                names=["doc_id", "text_key", "n_bytes", "n_removed", "n_spans", "kept_bytes"],
            )

    return run


def dedup_substrings(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WINDOW,
    gram: int = GRAM,
    in_one_task: int = IN_ONE_TASK,
) -> DataFrame:
    """Per row ``doc_id``, ``text_key``, ``n_bytes``, ``n_removed``, ``n_spans`` and
    ``kept_bytes`` (removal may cut a character, so these are bytes, not text)."""
    texts = texts_of(docs, id_col, text_col)
    gone = (
        repeat_groups(texts, width=width, gram=gram, in_one_task=in_one_task, merged=True)
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set(F.struct("low", "high")).alias("parts"))
    )
    kind = texts.schema["doc_id"].dataType.simpleString()
    return (
        texts.join(gone, same_document(texts, gone), "left")
        .select(texts["doc_id"], texts["text_key"], "text", "parts")
        .mapInArrow(
            _left_over(width),
            f"doc_id {kind}, text_key bigint, n_bytes bigint, n_removed bigint, "
            "n_spans bigint, kept_bytes binary",
        )
    )
