"""Quality classifier: cumulative-link regression on graded ratings.

Ratings are ordered grades. One score per text, the sum of the weights of its hashed
features, is shared by all grades; ordered thresholds cut the score's line, and a logistic
link gives the probability of being above each. From these come the expected grade and
the tail probability of the best grade, by which texts are selected.

Features are the 64-bit hashes of a text's distinct lower-cased words, of their stems (four
bytes) and of its shape
(shares of symbols, capitals, digits and unlike words, word length, size, each in steps).
Hashes are not folded together, so a long text meets a word's weight only where it holds
the word. The model is fitted on a sample of labelled rows, at most ``SAMPLE_PER_GRADE`` a
grade, taken by a hash of the id: that is all that reaches the driver, and the model holds
only features that ``LEAST_TEXTS`` sampled texts have and that tell grades apart well
beyond chance. Everything is scored.

Defined cases: a null text is empty; a null grade or label id is no label; ids labelled
several times have the mean of their grades, rounded down; a sampled id on several rows
counts with the text of the least hash; without labels, or with one grade only, there is no model: grades are null and every row is kept. Repeated rows are
scored each; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.llm.textarrays import Block, blocks, mixed, per_text

SAMPLE_PER_GRADE = 1500
LEAST_TEXTS = 4
LEAST_Z = 6.5
STEM_BYTES = 4
STEPS = 600
RATE = 0.1
SHRINK = 1e-5
LEAST_TAIL = 0.6

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[[c for c in range(128) if not chr(c).isalnum()]] = 0x20


def _share_step(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """0 for none, then one step for each doubling up to the whole."""
    share = part / np.maximum(whole, 1)
    return np.where(part == 0, 0, 10 + np.floor(np.log2(np.maximum(share, 1e-3)))).astype(np.int64)


def _in(data: np.ndarray, characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table[data]


def _distinct(hashes: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each hash once in its text, in text order."""
    order = np.lexsort((hashes, text_of))
    hashes, text_of = hashes[order], text_of[order]
    new = np.ones(len(order), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text_of[1:] != text_of[:-1])
    return hashes[new], text_of[new]


def _stems(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text_of: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``STEM_BYTES`` bytes of longer words."""
    long = ends - starts > STEM_BYTES
    at = starts[long]
    number = np.full(len(at), 1 << 60, np.uint64)
    for k in range(STEM_BYTES):
        number += data[at + k].astype(np.uint64) << np.uint64(8 * k)
    return mixed(number), text_of[long]


def features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts in a row, each once in its text, and where each text's begin."""
    data, bounds = block.data, block.bounds
    size = np.diff(bounds) - 1
    folded = Block(_FOLD[data], bounds)
    starts, ends, words_at = folded.words()
    hashes = folded.word_hashes(starts, ends)
    n_words = np.diff(words_at)
    text_of = np.repeat(np.arange(block.n), n_words)
    unlike_words, owner = _distinct(hashes, text_of)
    unlike = np.bincount(owner, minlength=block.n)
    stems, stem_owner = _distinct(*_stems(folded.data, starts, ends, text_of))
    upper = (data >= ord("A")) & (data <= ord("Z"))
    long_words = per_text(ends - starts, words_at)
    shapes = [
        _share_step(per_text(_in(data, b"#*$%&"), bounds), size),
        _share_step(per_text(_in(data, b"|<>"), bounds), size),
        _share_step(per_text(_in(data, b"!"), bounds), size),
        _share_step(per_text(_in(data, b"0123456789"), bounds), size),
        _share_step(per_text(upper, bounds), size),
        np.minimum(10, 10 * unlike // np.maximum(n_words, 1)),
        np.minimum(20, long_words // np.maximum(n_words, 1)),
        np.floor(np.log2(np.maximum(n_words, 1))).astype(np.int64),
    ]
    kinds = [mixed(s.astype(np.uint64) + np.uint64((i + 1) << 32)) for i, s in enumerate(shapes)]
    every = np.concatenate([unlike_words, stems, *kinds])
    owners = np.concatenate([owner, stem_owner, *[np.arange(block.n)] * len(kinds)])
    order = np.argsort(owners, kind="stable")
    return every[order], np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=block.n))])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class OrdinalModel:
    hashes: np.ndarray  # ascending
    weights: np.ndarray
    thresholds: np.ndarray  # ascending; one less than grades
    grades: np.ndarray

    def above(self, every: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For each text and threshold the probability of a grade above it."""
        weight = np.zeros(len(every))
        if len(self.hashes):
            place = np.minimum(np.searchsorted(self.hashes, every), len(self.hashes) - 1)
            weight = np.where(self.hashes[place] == every, self.weights[place], 0.0)
        total = np.concatenate([[0.0], np.cumsum(weight)])
        score = total[starts[1:]] - total[starts[:-1]]
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def fit(
    rows: list[np.ndarray],
    grades: np.ndarray,
    totals: dict[int, int] | None = None,
    *,
    steps: int = STEPS,
    rate: float = RATE,
    shrink: float = SHRINK,
    least_texts: int = LEAST_TEXTS,
    least_z: float = LEAST_Z,
) -> OrdinalModel | None:
    """Maximum likelihood with shrinkage by full-batch adaptive gradient steps, over the
    features whose share among some grade's texts is ``least_z`` deviations off chance."""
    names, rank = np.unique(grades, return_inverse=True)
    if len(names) < 2:
        return None
    every = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    hashes, place, counts = np.unique(every, return_inverse=True, return_counts=True)
    # Of each grade the share of texts that have a feature, against that of all texts.
    size = np.bincount(rank)
    chance = counts / len(rows)
    telling = np.zeros(len(hashes))
    for grade in range(len(names)):
        seen = np.bincount(place, weights=(rank == grade)[owner], minlength=len(hashes))
        spread = np.sqrt(np.maximum(size[grade] * chance * (1 - chance), 1e-9))
        telling = np.maximum(telling, np.abs(seen - size[grade] * chance) / spread)
    # A feature of few texts cannot be many deviations off: small samples ask for fewer.
    least_z = min(least_z, 0.35 * np.sqrt(len(rows)))
    often = (counts >= least_texts) & (telling >= least_z)
    renumbered = np.cumsum(often) - 1
    kept = often[place]
    index, owner = renumbered[place[kept]], owner[kept]
    hashes, n = hashes[often], int(often.sum())
    weights = np.zeros(n)
    # Thresholds: the first is free, each next lies a positive step above.
    free = np.concatenate([[0.0], np.zeros(len(names) - 2)])
    # A sampled text stands for as many rated ones as its grade has for each sampled.
    rated = size if totals is None else np.array([totals[int(g)] for g in names])
    share = (rated / size / rated.sum())[rank]
    slow, square = np.zeros(n + len(free)), np.zeros(n + len(free))
    for step in range(1, steps + 1):
        cuts = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
        score = np.bincount(owner, weights=weights[index], minlength=len(rows))
        above = _sigmoid(score[:, None] - cuts[None, :])
        padded = np.concatenate([np.ones((len(rows), 1)), above, np.zeros((len(rows), 1))], axis=1)
        slope = np.concatenate([np.zeros((len(rows), 1)), above * (1 - above), np.zeros((len(rows), 1))], axis=1)
        at = np.arange(len(rows))
        low, high = padded[at, rank], padded[at, rank + 1]
        inverse = share / np.maximum(low - high, 1e-9)
        by_score = -(slope[at, rank] - slope[at, rank + 1]) * inverse
        by_cut = np.zeros(len(names) + 1)
        np.add.at(by_cut, rank, slope[at, rank] * inverse)
        np.add.at(by_cut, rank + 1, -slope[at, rank + 1] * inverse)
        by_cut = by_cut[1:-1]
        tails = np.cumsum(by_cut[::-1])[::-1]
        by_free = tails * np.concatenate([[1.0], np.exp(free[1:])])
        by_weight = np.bincount(index, weights=by_score[owner], minlength=n) + shrink * weights
        gradient = np.concatenate([by_weight, by_free])
        slow = 0.9 * slow + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        move = rate * (slow / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weights -= move[:n]
        free -= move[n:]
    cuts = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
    return OrdinalModel(hashes, weights, cuts, names)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, block in blocks(batch["text"]):
            every, starts = features(block)
            lists = pa.ListArray.from_arrays(
                pa.array(starts, pa.int32()), pa.array(every.view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [batch["grade"].slice(at, block.n), lists], names=["grade", "features"]
            )


def fitted(
    docs: DataFrame,
    ratings: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_grade: int = SAMPLE_PER_GRADE,
    seed: int = 11,
) -> OrdinalModel | None:
    """The model of ``ratings`` (``doc_id``, ``grade``, whole numbers in order), fitted on a
    bounded sample: of ``per_grade`` ids a grade one text each, whatever rows they have."""
    rated = (
        ratings.where(F.col("doc_id").isNotNull() & F.col("grade").isNotNull())
        .groupBy("doc_id")
        .agg(F.floor(F.avg("grade")).cast("int").alias("grade"))
    )
    order = F.xxhash64(F.lit(seed), "doc_id")
    totals = {row["grade"]: row["count"] for row in rated.groupBy("grade").count().collect()}
    if not totals:
        return None
    sample = None
    for grade in sorted(totals):
        some = rated.where(F.col("grade") == grade).orderBy(order, "doc_id").limit(per_grade)
        sample = some if sample is None else sample.unionByName(some)
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    # At most per_grade ids a grade, so the sample is small at any size of the corpus.
    text = F.coalesce("text", F.lit(""))
    rows = (
        texts.join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", "grade")
        .agg(F.min_by(text, F.xxhash64(text)).alias("text"))
        .select("grade", "text")
        .mapInArrow(_feature_rows, "grade int, features array<bigint>")
        .toArrow()
    )
    if not rows.num_rows:
        return None
    lists = [np.array(x.as_py(), np.int64).view(np.uint64) for x in rows["features"]]
    grades = rows["grade"].to_numpy()
    # In one order whatever the partitions were: sums then agree to the last bit.
    order = sorted(range(len(lists)), key=lambda i: (grades[i], lists[i].tobytes()))
    return fit([lists[i] for i in order], grades[order], totals)


def _scored(model: OrdinalModel | None, least_tail: float, dropped: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, block in blocks(batch["text"]):
                if model is None:
                    grade = tail = pa.nulls(block.n, pa.float64())
                    keep = pa.array(np.ones(block.n, bool))
                else:
                    above = model.above(*features(block))
                    steps = np.diff(model.grades)
                    grade = pa.array(model.grades[0] + (above * steps).sum(axis=1))
                    tail = pa.array(above[:, -1])
                    keep = pa.array(above[:, -1] >= least_tail)
                kept = [name for name in batch.schema.names if name != dropped]
                yield pa.RecordBatch.from_arrays(
                    [*(batch[name].slice(at, block.n) for name in kept), grade, tail, keep],
                    names=[*kept, "expected_grade", "tail_probability", "kept"],
                )

    return run


def graded(
    texts: DataFrame,
    model: OrdinalModel | None,
    least_tail: float = LEAST_TAIL,
    *,
    keep_text: bool = False,
) -> DataFrame:
    """``text`` replaced by (or kept beside) ``expected_grade``, ``tail_probability`` and
    ``kept``; other columns of ``texts`` stay. No shuffle."""
    dropped = "" if keep_text else "text"
    fields = [
        f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields if f.name != dropped
    ]
    fields += ["expected_grade double", "tail_probability double", "kept boolean"]
    return texts.mapInArrow(_scored(model, least_tail, dropped), ", ".join(fields))


def grade_of(quality: Column, toxic: Column) -> Column:
    """0 poor, 1 well written but toxic, 2 well written and clean. A null quality is no
    rating, nor is a null ``toxic`` of a text that is not poor."""
    well = F.when(toxic == 1, 1).when(toxic == 0, 2)
    return F.when(quality == 0, 0).when(quality.isNotNull(), well)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key``, ``expected_grade``, ``tail_probability`` and ``kept`` per row."""
    ratings = labels.select("doc_id", grade_of(F.col("quality"), F.col("toxic")).alias("grade"))
    model = fitted(docs, ratings)
    text = F.coalesce(F.col("text"), F.lit(""))
    return graded(docs.select("doc_id", F.xxhash64(text).alias("text_key"), text.alias("text")), model)
