"""How the sources of a language diverge in the terms they use.

A term is a run of letters, as every code point but the ASCII ones that are no letters counts,
with only A-Z lower-cased. A language keeps the terms that stand in ``LEAST_DOCS`` or more
of its documents. Over these, a source's share of a term is smoothed and scaled to whole
numbers, p = 1 + floor(10^9 (count + 5) / (N + 5 V)), N its count of all V kept terms; all
arithmetic is on integers. Two sources diverge by the sum of |p - q| over all kept terms;
a term marks a source by p - q against the whole language.

Method: chunk factorization. White space cuts a document into chunks, of which it has far
fewer unlike ones than occurrences, and all documents together far fewer still. Tasks count
the chunks of their documents (numpy over the text's bytes); equal chunks then come
together from all tasks, and each is taken apart into terms once. Its terms carry the chunk's
counts back to languages and sources.

A term's documents are not the sum over its chunks ("the", "The" and "the," may share one). A
chunk in ``LEAST_DOCS`` documents settles its terms, so only rarer chunks carry the numbers of
their documents, fewer than that each, and only terms that rare chunks alone could lift
over the mark have their documents told apart. Nothing is estimated: the result is that of
counting every document's distinct terms.

Scale. What is shuffled is one row for each chunk and language of a task's slice, not one for
each chunk of a document; a word of all documents has one row a slice. Sorted by
Spark, chunks are merged row by row, so no group is held. Sources are compared in blocks of
``BLOCK`` by ``SLICE_TERMS`` terms, and each block gives one sum a pair: the result has all
pairs of a language's sources, so their number is what is asked for.

Defined cases: null text, language and source are empty; every row is a document of its own,
repeated or not; a source without terms has p of no occurrence everywhere; a language without
kept terms has pairs of value 0 and no terms; a language of one source has no pairs; ties go by
the item's UTF-8 bytes; an empty table gives an empty table; other columns are not read. A
text longer than a slice is cut at white space and its chunks are put together again.

Rows are told apart by their place in the scan, which a file gives again when a task is rerun;
hand over a table that is read from files.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlane.llm.common import written

LEAST_DOCS = 30
SCALE, SMOOTH = 1_000_000_000, 5
TOP_TERMS = 50

#: Bytes of text that a task counts at a time, rows of a batch it gives out.
SLICE_BYTES = 16 << 20
BATCH_ROWS = 1 << 16

#: Sources of a block and terms of a slice where pairs of sources are compared.
BLOCK, SLICE_TERMS = 256, 2048

TERM = re.compile(rb"[a-z\x80-\xff]+")
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

CHUNKS = "chunk binary, lang string, df bigint, docs array<bigint>, sources array<string>, counts array<bigint>"
TERMS = "lang string, source string, term string, n bigint, df bigint, docs array<bigint>"
_NUMBERS = pa.list_(pa.int64())
_CHUNKS = pa.schema(
    [("chunk", pa.binary()), ("lang", pa.string()), ("df", pa.int64()), ("docs", _NUMBERS),
     ("sources", pa.list_(pa.string())), ("counts", _NUMBERS)]
)
_TERMS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()),
     ("df", pa.int64()), ("docs", _NUMBERS)]
)


# Chunks of documents


def _split(data: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The chunks of texts that stand in ``data`` one after another, and each one's text."""
    solid = ~_SPACE[data]
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    edge = starts[starts < len(data)]
    opens[edge] = solid[edge]
    edge = edge[edge > 0] - 1
    closes[edge] = solid[edge]
    at, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    offsets = np.zeros(len(at) + 1, np.int32)
    np.cumsum(end - at, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[solid])]
    chunks = pa.Array.from_buffers(pa.binary(), len(at), buffers)
    return chunks, np.searchsorted(starts, at, side="right") - 1


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a run of rows with equal keys begins."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def _sums(values: np.ndarray, runs: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, runs) if len(runs) else values[:0]


def _lists(values: np.ndarray, lengths: np.ndarray, keep: np.ndarray) -> pa.ListArray:
    """Consecutive stretches of ``values`` as lists; those not kept are empty."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(np.where(keep, lengths, 0), out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[np.repeat(keep, lengths)]))


def _counted(
    chunks: pa.Array, doc: np.ndarray, times: np.ndarray | None, docs: pa.Table, least: int
) -> pa.Table:
    """Rows of ``CHUNKS``. ``doc`` has each chunk's row in ``docs`` (lang, source, doc)."""
    coded = chunks.dictionary_encode()
    words = coded.dictionary
    pair = doc.astype(np.int64) * max(len(words), 1) + coded.indices.to_numpy()
    if times is None:
        pair, n = np.unique(pair, return_counts=True)
    else:
        order = np.argsort(pair, kind="stable")
        pair, n = pair[order], times[order]
    of_doc, word = np.divmod(pair, max(len(words), 1))
    # Groups are numbered by language first, so the rows of a word and language stand together.
    langs = docs.column("lang").combine_chunks().dictionary_encode()
    sources = docs.column("source").combine_chunks().dictionary_encode()
    lang = langs.indices.to_numpy().astype(np.int64)
    group = lang * max(len(sources.dictionary), 1) + sources.indices.to_numpy()
    groups, group = np.unique(group, return_inverse=True)
    key = word * max(len(groups), 1) + group[of_doc]
    order = np.argsort(key, kind="stable")
    key, of_doc, n = key[order], of_doc[order], n[order]
    runs = _runs(key)
    df = np.diff(np.append(runs, len(key)))
    word, group = np.divmod(key[runs], max(len(groups), 1))
    lang, source = np.divmod(groups[group], max(len(sources.dictionary), 1)) if len(runs) else (group, group)
    whole = _runs(word, lang)
    of_whole = np.diff(np.append(whole, len(runs)))
    total = _sums(df, whole)
    ids = docs.column("doc").to_numpy()[of_doc]
    every = np.ones(len(whole), bool)
    listed = _lists(np.arange(len(runs)), of_whole, every)
    names = sources.dictionary.take(pa.array(source))
    return pa.table(
        [
            words.take(pa.array(word[whole])),
            langs.dictionary.take(pa.array(lang[whole])),
            pa.array(total),
            _lists(ids, total, total < least),
            pa.ListArray.from_arrays(listed.offsets, names),
            _lists(_sums(n, runs), of_whole, every),
        ],
        schema=_CHUNKS,
    )


def _of_long_text(data: np.ndarray, docs: pa.Table, least: int, slice_bytes: int) -> pa.Table:
    """One text, counted in stretches that end at white space."""
    parts, at = [], 0
    while at < len(data):
        end = min(at + slice_bytes, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            ahead = np.flatnonzero(_SPACE[data[end : end + slice_bytes]])
            end = end + int(ahead[0]) if len(ahead) else min(end + slice_bytes, len(data))
        counted = _split(data[at:end], np.zeros(1, np.int64))[0].value_counts()
        parts.append(pa.table({"chunk": counted.field("values"), "n": counted.field("counts")}))
        at = end
    whole = pa.concat_tables(parts).group_by("chunk").aggregate([("n", "sum")]).combine_chunks()
    chunks = whole.column("chunk").combine_chunks()
    return _counted(chunks, np.zeros(len(chunks), np.int64), whole.column("n_sum").to_numpy(), docs, least)


def _slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of ``most`` bytes or one row."""
    begin, size = 0, 0
    for row, length in enumerate(lengths.tolist()):
        if row > begin and size + length > most:
            yield begin, row
            begin, size = row, 0
        size += length
    if begin < len(lengths):
        yield begin, len(lengths)


def chunk_counter(least: int, slice_bytes: int):
    """For ``mapInArrow`` over ``lang``, ``source``, ``text`` and ``doc``."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = pa.Table.from_batches([batch])
            lengths = pc.binary_length(given.column("text")).to_numpy()
            for begin, end in _slices(lengths, slice_bytes):
                part = given.slice(begin, end - begin)
                text = pa.concat_arrays([c.cast(pa.large_binary()) for c in part.column("text").chunks])
                offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
                docs = part.select(["lang", "source", "doc"])
                if offsets[-1] == offsets[0]:
                    continue
                data = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
                if len(text) == 1 and len(data) > slice_bytes:
                    table = _of_long_text(data, docs, least, slice_bytes)
                else:
                    chunks, doc = _split(data, offsets[:-1] - offsets[0])
                    table = _counted(chunks, doc, None, docs, least)
                yield from table.to_batches(max_chunksize=BATCH_ROWS)

    return count


# Terms of chunks


class _Terms:
    """Terms of unlike chunks: ``values``, how often each stands in its chunk, where a chunk's begin."""

    def __init__(self, chunks: list[bytes]) -> None:
        values, counts, begins = [], [], [0]
        for chunk in chunks:
            found = TERM.findall(chunk.lower())
            if len(found) > 1:
                each = Counter(found)
                values += each.keys()
                counts += each.values()
            elif found:
                values += found
                counts.append(1)
            begins.append(len(values))
        self.values = pa.array(values, pa.binary()).cast(pa.string())
        self.counts = np.array(counts, np.int64)
        self.begins = np.array(begins, np.int64)

    def of(self, chunk: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rows with these chunks: the row and the term of everything they expand to."""
        sizes = self.begins[chunk + 1] - self.begins[chunk]
        row = np.repeat(np.arange(len(chunk)), sizes)
        within = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return row, self.begins[chunk][row] + within


def _whole(lang: pa.Array, df: np.ndarray, docs: pa.ListArray, chunk: np.ndarray, terms: _Terms) -> pa.Table:
    """Rows of ``TERMS`` without source, by chunk and language."""
    row, term = terms.of(chunk)
    at = pa.array(row)
    none = pa.nulls(len(row), pa.string())
    zeros = pa.array(np.zeros(len(row), np.int64))
    columns = [lang.take(at), none, terms.values.take(pa.array(term)), zeros, pa.array(df[row]), docs.take(at)]
    return pa.table(columns, schema=_TERMS)


def _by_source(batch: pa.RecordBatch, chunk: np.ndarray, langs: pa.Array, terms: _Terms) -> pa.Table:
    """Rows of ``TERMS`` with a source: what a batch has of a chunk in all slices, summed up."""
    listed, counts = batch.column("sources"), batch.column("counts").flatten().to_numpy()
    sources = listed.flatten().dictionary_encode()
    sizes = np.diff(listed.offsets.to_numpy())
    lang = np.repeat(langs.indices.to_numpy(), sizes)
    chunk, source = np.repeat(chunk, sizes), sources.indices.to_numpy()
    order = np.lexsort((source, lang, chunk))
    chunk, lang, source, counts = chunk[order], lang[order], source[order], counts[order]
    runs = _runs(chunk, lang, source)
    n = _sums(counts, runs)
    row, term = terms.of(chunk[runs])
    zeros = np.zeros(len(row), np.int64)
    return pa.table(
        [
            langs.dictionary.take(pa.array(lang[runs][row])),
            sources.dictionary.take(pa.array(source[runs][row])),
            terms.values.take(pa.array(term)),
            pa.array(n[row] * terms.counts[term]),
            pa.array(zeros),
            _lists(zeros[:0], zeros, zeros == 0),
        ],
        schema=_TERMS,
    )


def chunk_merger(least: int):
    """For ``mapInArrow`` over rows of ``CHUNKS`` that are sorted by chunk and language.

    Gives rows of ``TERMS``: occurrences by source, and by language (null source) how many
    documents a chunk of the term stands in, with their numbers where they are few. Of a
    chunk that goes on in the next batch only that last row is held.
    """

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # chunk, language, documents, their numbers
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column("chunk").dictionary_encode()
            chunk, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
            terms = _Terms(words)
            langs = batch.column("lang").dictionary_encode()
            yield from _by_source(batch, chunk, langs, terms).to_batches(max_chunksize=BATCH_ROWS)
            runs = _runs(chunk, langs.indices.to_numpy())
            df = _sums(batch.column("df").to_numpy(), runs)
            docs = batch.column("docs")
            offsets = np.append(docs.offsets.to_numpy()[runs], docs.offsets.to_numpy()[-1])
            values = docs.values.to_numpy()[offsets[0] : offsets[-1]]
            lists = _lists(values, np.diff(offsets), df < least)
            lang = batch.column("lang").take(pa.array(runs))
            chunk = chunk[runs]
            first = 0
            if held and held[:2] == (words[chunk[0]], lang[0].as_py()):
                total = held[2] + int(df[0])
                more = held[3] + lists[0].as_py() if total < least else []
                if len(runs) == 1:
                    held = (*held[:2], total, more)
                    continue
                held = (*held[:2], total, more)
                first = 1
            if held:
                yield from _one(held)
            end = len(runs) - 1
            if end > first:
                part = slice(first, end)
                rows = _whole(lang[part], df[part], lists[part], chunk[part], terms)
                yield from rows.to_batches(max_chunksize=BATCH_ROWS)
            held = (words[chunk[end]], lang[end].as_py(), int(df[end]), lists[end].as_py())
        if held:
            yield from _one(held)

    def _one(held: tuple) -> Iterator[pa.RecordBatch]:
        chunk, lang, df, docs = held
        lists = pa.array([docs], pa.list_(pa.int64()))
        one = _whole(pa.array([lang]), np.array([df]), lists, np.zeros(1, np.int64), _Terms([chunk]))
        yield from one.to_batches()

    return merge


def term_rows(docs: DataFrame, least: int = LEAST_DOCS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Rows of ``TERMS``, written."""
    given = docs.select(
        *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")),
        F.monotonically_increasing_id().alias("doc"),
    )
    chunks = given.mapInArrow(chunk_counter(least, slice_bytes), CHUNKS)
    sorted_chunks = chunks.repartition("chunk").sortWithinPartitions("chunk", "lang")
    return written(sorted_chunks.mapInArrow(chunk_merger(least), TERMS))


def kept_terms(terms: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """``lang`` and ``term`` of ``least`` or more documents."""
    whole = terms.where(F.col("source").isNull())
    bounds = whole.groupBy("lang", "term").agg(F.max("df").alias("least"), F.sum("df").alias("most"))
    sure = bounds.where(F.col("least") >= least).select("lang", "term")
    open_ = bounds.where((F.col("least") < least) & (F.col("most") >= least)).select("lang", "term")
    told = (
        whole.join(open_, ["lang", "term"])
        .select("lang", "term", F.explode("docs").alias("doc"))
        .distinct()
        .groupBy("lang", "term")
        .agg(F.count("*").alias("df"))
    )
    return sure.unionByName(told.where(F.col("df") >= least).select("lang", "term"))


# Divergence


def share(count: Column, n: Column, v: Column) -> Column:
    """p, exactly: the product needs more than 64 bits."""
    wide = "decimal(38,0)"
    over = (count.cast("decimal(20,0)") + SMOOTH) * F.lit(SCALE).cast("decimal(10,0)")
    under = n.cast("decimal(20,0)") + v.cast("decimal(20,0)") * SMOOTH
    quotient = F.call_function("div", over.cast(wide), under.cast(wide))
    return F.when(v > 0, quotient + 1).otherwise(1).cast("bigint")


def pair_sums(key: tuple, table: pa.Table) -> pa.Table:
    """Of one slice of terms and two blocks of sources: sums of |p - q| for each pair."""
    sources = table.column("source").combine_chunks().dictionary_encode()
    names, who = sources.dictionary, sources.indices.to_numpy()
    terms = table.column("term").combine_chunks().dictionary_encode()
    base = terms.indices.is_null().to_numpy(zero_copy_only=False)
    p = table.column("p").to_numpy()
    block = np.zeros(len(names), np.int64)
    block[who] = table.column("block").to_numpy()
    grid = np.zeros((len(names), len(terms.dictionary)), np.int64)
    grid[who[base]] = p[base][:, None]
    grid[who[~base], terms.indices.drop_null().to_numpy()] = p[~base]
    left, right = key[2].as_py(), key[3].as_py()
    ours = np.flatnonzero(block == right)
    one, other, value = [], [], []
    for i in np.flatnonzero(block == left):
        them = ours[ours != i]
        one.append(np.full(len(them), i))
        other.append(them)
        value.append(np.abs(grid[them] - grid[i]).sum(axis=1))
    none = [np.zeros(0, np.int64)]
    one, other, value = (np.concatenate(x or none) for x in (one, other, value))
    if left != right:  # else each pair was met from both sides
        one, other, value = np.append(one, other), np.append(other, one), np.append(value, value)
    lang = pa.array([key[0].as_py()] * len(one), pa.string())
    return pa.table(
        {"lang": lang, "source": names.take(pa.array(one)), "item": names.take(pa.array(other)), "value": value}
    )


def _pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item`` and ``value`` of all pairs of a language's sources."""
    slices = F.greatest(F.ceil(F.col("v") / SLICE_TERMS), F.lit(1)).cast("bigint")
    blocks = F.ceil(F.col("sources") / BLOCK).cast("bigint")
    groups = groups.withColumns({"slices": slices, "blocks": blocks})
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).alias("block")
    known = ("lang", "source", "n", "v", "slices", "blocks")
    valued = counts.join(groups.select(*known), ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        share(F.col("c"), F.col("n"), F.col("v")).alias("p"),
        F.pmod(F.xxhash64("term"), F.col("slices")).alias("slice"),
        "blocks",
        block,
    )
    # What a source has of a term it lacks.
    bare = groups.select(
        "lang",
        "source",
        F.lit(None).cast("string").alias("term"),
        share(F.lit(0), F.col("n"), F.col("v")).alias("p"),
        F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
        "blocks",
        block,
    )
    with_other = valued.unionByName(bare).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    sums = (
        with_other.withColumns(
            {"low": F.least("block", "other"), "high": F.greatest("block", "other")}
        )
        .select("lang", "slice", "low", "high", "source", "term", "p", "block")
        .groupBy("lang", "slice", "low", "high")
        .applyInArrow(pair_sums, "lang string, source string, item string, value bigint")
    )
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    if most is not None:
        ranked = ranked.where(F.col("rank") <= most)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit_sources(
    docs: DataFrame, *, least: int = LEAST_DOCS, top: int = TOP_TERMS, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``: in part ``pair`` every other source of
    the language by divergence, in part ``term`` the ``top`` terms that mark the source."""
    terms = term_rows(docs, least, slice_bytes)
    kept = written(kept_terms(terms, least))
    counts = terms.where(F.col("source").isNotNull()).groupBy("lang", "source", "term").agg(F.sum("n").alias("c"))
    counts = written(counts.join(kept, ["lang", "term"], "left_semi"))
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("v"))
    found = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    by_source = counts.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    groups = (
        found.join(by_source, ["lang", "source"], "left")
        .join(of_lang, "lang", "left")
        .select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v")))
    )
    langs = groups.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count("*").alias("sources"))
    groups = written(groups.join(langs, "lang"))

    whole = counts.groupBy("lang", "term").agg(F.sum("c").alias("lang_c"))
    p = share(F.col("c"), F.col("n"), F.col("v"))
    q = share(F.col("lang_c"), F.col("lang_n"), F.col("v"))
    marked = (
        counts.where(F.col("c") > 0)
        .join(groups, ["lang", "source"])
        .join(whole, ["lang", "term"])
        .select("lang", "source", F.col("term").alias("item"), (p - q).alias("value"))
        .where(F.col("value") > 0)
    )
    pairs = _ranked(_pairs(counts, groups), "pair")
    return pairs.unionByName(_ranked(marked, "term", top))
