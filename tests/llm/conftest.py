from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Extra columns whose names the operators use themselves.
        T.StructField("text_key", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("n_words", T.StringType()),
        T.StructField("doc", T.StringType()),
        T.StructField("copies", T.StringType()),
    ]
)

PARAGRAPH = " ".join(f"word{k * k % 97}x{k % 13}" for k in range(120))
LINES = "\n".join(f"line {k} of a text with several words" for k in range(9))


def awkward_rows():
    """Nulls, empty and very long texts, ties, repeated rows and runs."""
    texts = [
        (1, PARAGRAPH),
        (2, PARAGRAPH + " and more words at its end"),
        (3, "before it " + PARAGRAPH),
        (4, LINES),
        (5, "a new first line\n" + LINES + "\nand a last one"),
        (6, None),
        (7, ""),
        (8, " \n\t\x0b "),
        (9, "one"),
        (10, "same " * 400),
        (11, "same " * 300 + "other"),
        (12, "ab " * 300),
        (13, LINES + "\n" + LINES),
        (14, "é日本 \U0001f600 " * 60),
        (15, " ".join(f"long{k}" for k in range(30_000))),
        (16, "x" * 3000),
        (17, "\n" * 50),
        (18, PARAGRAPH.upper()),
    ]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in texts]
    rows += [(1, PARAGRAPH, "en", "s1", 1)] * 2  # repeated as they are
    rows += [(2, "another text of an id that is taken", "en", None, None)]
    rows += [(None, PARAGRAPH, None, None, None), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def frame(spark):
    def build(rows):
        return spark.createDataFrame(
            [(*row, "clash", "clash", "clash", "clash", "clash", "clash") for row in rows], DOCS
        )

    return build


@pytest.fixture(scope="session")
def awkward(frame):
    return frame(awkward_rows())


@pytest.fixture(scope="session")
def nothing(frame):
    return frame([])
