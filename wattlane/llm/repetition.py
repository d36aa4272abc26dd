"""Quality rules on repetition: characters inside duplicated n-grams and lines.

Rolling hashes of n words, for several n, are sorted within each text; words under an
n-gram found twice or more in the text count as covered, the first finding included, and
a word under several counts once. A text fails where the covered characters exceed a
share of all characters in words, or where lines equal to earlier ones hold too many. The
shares are those published for the quality rules of large web corpora; short n-grams,
which prose repeats by itself, take part only in the base counts.

Defined cases: a null text is empty; a text without words has all counts 0 and fails the
base rule; repeated rows are judged each; an empty table gives an empty table; other
columns are not read. No shuffle; a text longer than a block is looked at alone and whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.llm.textarrays import BASE, Block, blocks, mixed, per_text

#: Greatest share of characters in duplicated n-grams, by n.
MOST_IN_NGRAMS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
MOST_IN_LINES = 0.20
LEAST_WORDS = 50
BASE_N = 3
SYMBOLS = b"#*$%&|<>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _covered(grams: np.ndarray, n: int, text_of: np.ndarray, n_words: int) -> np.ndarray:
    """Words under an n-gram that its text holds twice or more."""
    inside = np.flatnonzero(text_of[: n_words - n + 1] == text_of[n - 1 :])
    keys = mixed(grams[inside] + text_of[inside].astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(inside), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(n_words + 1, np.int32)
    at = inside[twice]
    edge[at] += 1  # no start comes twice, and no end
    edge[at + n] -= 1
    return np.cumsum(edge[:-1]) > 0


def measures(block: Block, ngrams: dict[int, float]) -> dict[str, np.ndarray]:
    data, bounds = block.data, block.bounds
    starts, ends, words_at = block.words()
    total = len(starts)
    n_words = np.diff(words_at)
    text_of = np.repeat(np.arange(block.n), n_words)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    chars = lead[ends] - lead[starts]
    out = {
        "n_words": n_words,
        "word_chars": per_text(chars, words_at),
        "n_symbols": per_text(_SYMBOL[data], bounds),
    }

    separator = np.zeros(len(data), bool)
    separator[bounds[1:] - 1] = True
    line_starts, line_ends = block.lines(separator)
    in_words = np.concatenate([[0], np.cumsum(chars, dtype=np.int64)])
    first_word = np.searchsorted(starts, line_starts)
    last_word = np.searchsorted(starts, line_ends)
    full = np.flatnonzero(last_word > first_word)
    line_text = np.searchsorted(bounds, line_starts[full], side="right") - 1
    keys = block.line_hashes(line_starts, line_ends, separator)[full]
    keys = mixed(keys + line_text.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(full), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    line_chars = (in_words[last_word] - in_words[first_word])[full]
    out["n_dup_lines"] = np.bincount(line_text[again], minlength=block.n)
    out["dup_line_chars"] = np.bincount(
        line_text[again], weights=line_chars[again], minlength=block.n
    ).astype(np.int64)

    hashes = block.word_hashes(starts, ends)
    grams = hashes
    lengths = {BASE_N, *ngrams}
    for n in range(1, max(lengths) + 1):
        if n > 1:
            grams = grams[:-1] * BASE + hashes[n - 1 :] if total >= n else grams[:0]
        if n not in lengths:
            continue
        covered = _covered(grams, n, text_of, total) if total >= n else np.zeros(total, bool)
        if n == BASE_N:
            out["n_repeat_words"] = per_text(covered, words_at)
        if n in ngrams:
            out[f"dup_{n}_chars"] = per_text(chars * covered, words_at)
    return out


def _measured(ngrams: dict[int, float], most_in_lines: float, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, block in blocks(batch["text"]):
                found = measures(block, ngrams)
                size, words = found["word_chars"], found["n_words"]
                failed = (words < LEAST_WORDS) | (100 * found["n_repeat_words"] > 50 * words)
                repeats = found["dup_line_chars"] > most_in_lines * size
                for n, most in ngrams.items():
                    repeats |= found[f"dup_{n}_chars"] > most * size
                found |= {"base_failed": failed, "kept": ~failed & ~repeats}
                ids = batch["doc_id"].slice(at, block.n)
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(found[name]) for name in names)], names=["doc_id", *names]
                )

    return run


def repetition_rules(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    ngrams: dict[int, float] | None = None,
    most_in_lines: float = MOST_IN_LINES,
) -> DataFrame:
    """Per row: counts, characters in duplicated lines and n-grams, ``base_failed``, ``kept``."""
    ngrams = MOST_IN_NGRAMS if ngrams is None else ngrams
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    counts += ["dup_line_chars", *(f"dup_{n}_chars" for n in ngrams)]
    fields = [f"doc_id {rows.schema['doc_id'].dataType.simpleString()}"]
    fields += [f"{name} bigint" for name in counts] + ["base_failed boolean", "kept boolean"]
    return rows.mapInArrow(
        _measured(ngrams, most_in_lines, [*counts, "base_failed", "kept"]), ", ".join(fields)
    )
