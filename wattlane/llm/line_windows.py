"""Line dedup by overlapping three-line windows, over all documents.

Every three consecutive lines of a text are a window, named by a 128-bit hash of the
three line hashes. A window that occurs more than once anywhere keeps its first occurrence
(least document id, then least line); the lines under all others go, windows that overlap
merging into one run. Windows are judged on the input, not on what is left.

Defined cases: a null text is empty; a text of fewer than three lines has no window and
stays; windows of three lines without a word are not looked at; rows that repeat id and
text are one document and get the same answer; a null id comes first; other columns are
not read. No line is dropped for being frequent, and none is kept for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import same_document, texts_of

WINDOW_LINES = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _names(hashes: Column, blank: Column, n: int) -> Column:
    """Window names by position; null where no line has a word."""

    def window(i: Column) -> Column:
        rows = [i + k for k in range(n)]
        name = F.struct(
            F.xxhash64(*(F.element_at(hashes, r)["a"] for r in rows)).alias("a"),
            F.xxhash64(F.lit(n), *(F.element_at(hashes, r)["b"] for r in rows)).alias("b"),
        )
        empty = F.lit(True)
        for r in rows:
            empty = empty & F.element_at(blank, r)
        return F.when(~empty, name)

    return F.when(
        F.size(hashes) >= n, F.transform(F.sequence(F.lit(1), F.size(hashes) - n + 1), window)
    )


def window_rows(texts: DataFrame, n: int = WINDOW_LINES) -> DataFrame:
    """``doc_id``, ``text_key``, ``line`` (from 0) and the window's name ``a``, ``b``."""
    lines = _lines(F.col("text"))
    hashed = texts.select(
        "doc_id",
        "text_key",
        F.transform(
            lines,
            lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(n), x).alias("b")),
        ).alias("hashes"),
        F.transform(lines, lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", "    ")) == "").alias("blank"),
    ).where(F.size("hashes") >= n)
    names = _names(F.col("hashes"), F.col("blank"), n)
    return (
        hashed.select("doc_id", "text_key", F.posexplode(names).alias("line", "name"))
        .where(F.col("name").isNotNull())
        .select("doc_id", "text_key", "line", F.col("name.a").alias("a"), F.col("name.b").alias("b"))
    )


def later_windows(windows: DataFrame) -> DataFrame:
    """Windows that occurred before.

    First occurrences come from a grouping that combines before its shuffle, so a window
    that a third of all documents share reaches its task as one row from each other task.
    Only names that repeat join back, one row per name against the windows, a join whose
    large side Spark can split.
    """
    place = F.struct("doc_id", "text_key", "line")
    repeated = (
        windows.groupBy("a", "b")
        .agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .select("a", "b", "first")
    )
    return (
        windows.join(repeated, ["a", "b"])
        .where(place != F.col("first"))
        .select("doc_id", "text_key", "line")
    )


def dedup_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = WINDOW_LINES
) -> DataFrame:
    """``doc_id``, ``text_key``, ``text`` and, for each row, ``n_lines``, ``removed`` (line
    numbers from 0, ascending) and ``kept_text``."""
    texts = texts_of(docs, id_col, text_col)
    covered = (
        later_windows(window_rows(texts, n))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("line").alias("starts"))
    )
    joined = texts.join(covered, same_document(texts, covered), "left").select(
        texts["*"], "starts"
    )
    cut = without_windows(joined, F.col("text"), n)
    return cut.select(
        "doc_id",
        "text_key",
        "text",
        F.size("lines").cast("bigint").alias("n_lines"),
        "removed",
        F.when(F.size("removed") == 0, F.col("text")).otherwise(F.col("kept_text")).alias("kept_text"),
    )


def without_windows(rows: DataFrame, text: Column, n: int = WINDOW_LINES) -> DataFrame:
    """``rows`` with ``lines``, ``removed`` and ``kept_text``, where ``starts`` (null: none)
    has the windows that go."""
    starts = F.coalesce("starts", F.array().cast("array<int>"))
    runs = F.flatten(F.transform(starts, lambda s: F.sequence(s, s + (n - 1))))
    split = rows.withColumns(
        {
            "removed": F.array_sort(F.array_distinct(runs)),
            "lines": _lines(F.coalesce(text, F.lit(""))),
        }
    )
    numbers = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.transform(F.array_except(numbers, F.col("removed")), lambda i: F.get("lines", i))
    return split.withColumn("kept_text", F.array_join(kept, "\n"))
