"""SimHash near-dedup: fingerprints joined on the codewords of a Golay code.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. Where two fingerprints
differ in at most ``MOST_BITS`` = 3 bits, at least two of the three segments differ in at
most one bit each (else two segments would hold four). The binary Golay code of length 23
is perfect: each 23-bit word lies within three bits of just one codeword, whose index is
the word's code. A segment is filed under its own code; it is looked up under the codes of
itself and of all words one bit away, six at most, so two segments that differ in at most
one bit meet. Keys are pairs of codes from two segments: each fingerprint is filed under
three keys and looked up under some eighty.

Buckets, where keys agree, are verified by counting differing bits, filed fingerprints
against looked-up ones, in blocks of bounded memory; a bucket leaves a spanning forest of
its links, never all its pairs. Only unlike fingerprints come here; copies meet before,
in a grouping that combines before its shuffle. Forests of all buckets give components.

Defined cases: a null text is empty; a text without words has fingerprint 0 and links like
any other; fewer words than a shingle make one shingle; null ids never are a component's
id unless it has no other; repeated rows are rows of one component; an empty table gives
an empty table; other columns are not read. No bucket is capped.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import kept_aside
from wattlane.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
MOST_BITS = 3

#: Segments as (lowest bit, width); at most one of them can hold two differing bits.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Generator polynomial of the code, a fixed value: x^11+x^10+x^6+x^5+x^4+x^2+1.
GENERATOR = 0b110001110101
LOOK_BLOCK = 2048


@functools.cache
def codes() -> np.ndarray:
    """The code of each 23-bit word: the index of its codeword."""
    def remainder(words: np.ndarray) -> np.ndarray:
        left = words.copy()
        for bit in range(22, 10, -1):
            left ^= np.where(left >> bit & 1, GENERATOR << (bit - 11), 0)
        return left

    singles = 1 << np.arange(23, dtype=np.int32)
    i, j, k = np.meshgrid(*[np.concatenate([[0], singles])] * 3, indexing="ij")
    errors = np.unique(i | j | k).astype(np.int32)  # all words of weight 3 or less
    error_of = np.zeros(1 << 11, np.int32)
    error_of[remainder(errors)] = errors
    every = np.arange(1 << 23, dtype=np.int32)
    nearest = every ^ error_of[remainder(every)]
    return (nearest >> 11).astype(np.uint16)


def _near_codes(segment: np.ndarray, width: int) -> np.ndarray:
    """Codes of each segment and of its neighbours one bit away; repeats become 65535."""
    flips = np.concatenate([[0], 1 << np.arange(width, dtype=np.int64)])
    found = codes()[segment[:, None] ^ flips[None, :]]
    found.sort(axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = 65535
    found.sort(axis=1)
    return found[:, :6]


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``key``, ``looked`` (0 filed, 1 looked up) and fingerprint of all entries."""
    parts = [(prints >> np.uint64(low) & np.uint64((1 << w) - 1)).astype(np.int64) for low, w in SEGMENTS]
    own = [codes()[p].astype(np.int64) for p in parts]
    near = [_near_codes(p, w) for p, (_, w) in zip(parts, SEGMENTS, strict=True)]
    keys, looked, whose = [], [], []
    for pair, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        tag = pair << 24
        keys.append(own[i] << 12 | own[j] | tag)
        looked.append(np.zeros(len(prints), np.int8))
        whose.append(prints)
        both = near[i].astype(np.int64)[:, :, None] << 12 | near[j].astype(np.int64)[:, None, :] | tag
        real = (near[i] != 65535)[:, :, None] & (near[j] != 65535)[:, None, :]
        row, _, _ = np.nonzero(real)
        keys.append(both[real])
        looked.append(np.ones(len(row), np.int8))
        whose.append(prints[row])
    return np.concatenate(keys), np.concatenate(looked), np.concatenate(whose)


def fingerprint(text: str) -> int:
    """Bits set in over half of the shingle hashes; repeats count."""
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space alone
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE_WORDS)), strict=False))
    hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    over = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(over.view("<u8")[0])


def _printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(x) for x in batch["text"].to_pylist()]
        signed = np.array(prints, np.uint64).view(np.int64)
        kept = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch[name] for name in kept), pa.array(signed)], names=[*kept, "print"]
        )


def fingerprints(texts: DataFrame) -> DataFrame:
    """``text`` replaced by ``print``, the fingerprint as a signed number."""
    fields = [
        f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields if f.name != "text"
    ]
    return texts.mapInArrow(_printed, ", ".join([*fields, "print bigint"]))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch["print"].to_numpy().view(np.uint64)
        for at in range(0, len(prints), 4096):
            key, looked, whose = keys_of(prints[at : at + 4096])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(looked), pa.array(whose.view(np.int64))],
                names=["key", "looked", "print"],
            )


def forest(filed: np.ndarray, looked: np.ndarray) -> list[tuple[int, int]]:
    """Links that join up all filed and looked-up prints at most ``MOST_BITS`` bits apart.

    A looked-up print links to one filed print of each group in its reach, groups being
    those that earlier links made; so links stay fewer than prints.
    """
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for start in range(0, len(filed), LOOK_BLOCK):
        other = filed[start : start + LOOK_BLOCK]
        for at in range(0, len(looked), LOOK_BLOCK):
            some = looked[at : at + LOOK_BLOCK]
            apart = np.bitwise_count(some[:, None] ^ other[None, :])
            near = (apart <= MOST_BITS) & (apart > 0)
            rows = np.flatnonzero(near.any(axis=1))
            if not len(rows):
                continue
            groups = np.array([top(x) for x in other.tolist()], np.uint64)
            for row in rows.tolist():
                columns = np.flatnonzero(near[row])
                if len(columns) > 1:
                    _, firsts = np.unique(groups[columns], return_index=True)
                    columns = columns[firsts]
                a = int(some[row])
                for b in other[columns].tolist():
                    x, y = top(a), top(b)
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        links.append((a, b))
    return links


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets come sorted by key; one may reach over several batches."""
    held_key: int | None = None
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def close() -> list[tuple[int, int]]:
        if not held:
            return []
        looked = np.concatenate([x for x, _ in held])
        prints = np.concatenate([x for _, x in held])
        filed, sought = prints[looked == 0], prints[looked == 1]
        return forest(filed, sought) if len(filed) and len(sought) else []

    for batch in batches:
        key = batch["key"].to_numpy()
        looked = batch["looked"].to_numpy()
        prints = batch["print"].to_numpy().view(np.uint64)
        cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
        links: list[tuple[int, int]] = []
        edges = np.concatenate([[0], cuts, [len(key)]])
        # Buckets without a filed print are passed over together.
        filed_before = np.concatenate([[0], np.cumsum(looked == 0)])
        alone = (filed_before[edges[1:]] == filed_before[edges[:-1]]) | (np.diff(edges) < 2)
        alone[0] = alone[-1] = False
        for s, e in zip(edges[:-1][~alone].tolist(), edges[1:][~alone].tolist(), strict=True):
            if s == e:
                continue
            if held_key is None or key[s] != held_key:
                links += close()
                held_key, held = int(key[s]), []
            held.append((looked[s:e], prints[s:e]))
        if links:
            yield _edge_batch(links)
    links = close()
    if links:
        yield _edge_batch(links)


def _edge_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(links, np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def links_of(prints: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between unlike fingerprints (``print``), enough for components."""
    entries = prints.mapInArrow(_keyed, "key bigint, looked tinyint, print bigint")
    return (
        entries.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_linked, "a bigint, b bigint")
        .distinct()
    )


def near_groups(printed: DataFrame) -> DataFrame:
    """``print`` and ``component_id``, the least ``doc_id`` of all rows within reach."""
    smallest = kept_aside(printed.groupBy("print").agg(F.min("doc_id").alias("least_id")))
    roots = components(links_of(smallest.select("print")))
    rooted = smallest.join(roots, smallest["print"] == roots["vertex"], "left").select(
        "print", "least_id", F.coalesce("root", "print").alias("root")
    )
    rooted = kept_aside(rooted)
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.join(ids, "root").select("print", "component_id")


def near_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_key``, ``print``, ``fingerprint`` (hex) and ``component_id`` per row."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text")
    )
    printed = kept_aside(fingerprints(rows))
    return printed.join(near_groups(printed), "print").select(
        "doc_id",
        "text_key",
        "print",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
