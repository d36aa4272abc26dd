"""The source divergence audit against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from wattlane.llm import source_audit


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select("lang", "source", "part", "item", "value", "rank").collect())


def made_up(seed=3, n=160):
    """Variants of a term in unlike chunks, some rare alone and frequent together."""
    rng = random.Random(seed)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)]
    rows = []
    for _ in range(n):
        lang = rng.choice(["en", "de", None])
        text = []
        for _ in range(rng.randrange(60)):
            word = words[min(int(rng.expovariate(0.05)), 119)]
            style = rng.randrange(6)
            text.append([word, word.upper(), f"{word},", f"({word})", f"{word}-{rng.choice(words)}", f"{word}é1{word}"][style])
        rows.append((lang, f"s{rng.randrange(4)}", rng.choice([" ", "\n", " \t"]).join(text)))
    rows += [("en", None, None), ("en", "bare", "1 2 3"), ("it", "only", "uno due"), (None, None, "")]
    return rows


def frame_of(spark, rows, parts=3):
    given = [(k, text, lang, source, len(text or ""), "clash", "clash") for k, (lang, source, text) in enumerate(rows)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, term string, chunk string"
    return spark.createDataFrame(given, schema).repartition(parts, "doc_id")


@pytest.mark.parametrize("least", [2, 5, 30])
def test_against_brute_force(spark, tmp_path, least):
    rows = made_up()
    frame_of(spark, rows).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    expected = brute.audit(rows, least)
    assert rows_of(source_audit.audit_sources(docs, least=least)) == expected
    # Slices so small that each text is one, and longer ones are cut.
    assert rows_of(source_audit.audit_sources(docs, least=least, slice_bytes=40)) == expected


def test_term_that_only_rare_chunks_carry(spark):
    """Three chunks in two documents each; one document has two of them: five, not six."""
    texts = ["term, term;", "term,", "term; x", "term.", "term. x"]
    rows = [("en", f"s{k % 2}", t) for k, t in enumerate(texts)]
    docs = frame_of(spark, rows, 1)
    for least in (5, 6):
        found = {r.term for r in source_audit.kept_terms(source_audit.term_rows(docs, least), least).collect()}
        assert found == ({"term"} if least == 5 else set())


def test_repeated_rows_and_one_hot_source(spark):
    rows = [("en", "hot", "the same text again")] * 200 + [("en", "b", "The other text")] * 31
    assert rows_of(source_audit.audit_sources(frame_of(spark, rows))) == brute.audit(rows, 30)


def test_more_sources_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "BLOCK", 3)
    monkeypatch.setattr(source_audit, "SLICE_TERMS", 4)
    rng = random.Random(1)
    rows = [("en", f"s{k % 11}", " ".join(rng.choices("abcdefghijklmnop", k=9))) for k in range(90)]
    assert rows_of(source_audit.audit_sources(frame_of(spark, rows), least=3)) == brute.audit(rows, 3)


def test_nothing(spark):
    assert source_audit.audit_sources(frame_of(spark, [])).count() == 0


def test_shares_beyond_64_bits(spark):
    count, n = 7 * 10**17, 9 * 10**18
    row = spark.range(1).selectExpr(f"{count}L as c", f"{n}L as n", "3L as v")
    p = row.select(source_audit.share(row["c"], row["n"], row["v"]).alias("p")).first().p
    assert p == 1 + 10**9 * (count + 5) // (n + 15)


def test_chunks_of_adjacent_texts():
    texts = [b"", b"ab c", b"", b"d\x0be", b" ", b"f", b"\xc3\xa9 "]
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum([0] + [len(t) for t in texts[:-1]])
    chunks, at = source_audit._split(data, starts)
    assert list(zip(chunks.to_pylist(), at.tolist(), strict=True)) == [
        (c, k) for k, t in enumerate(texts) for c in t.split()
    ]


def test_a_chunk_over_many_batches():
    """A run that is cut by batches gives the same rows as one batch."""
    rows = [
        {"chunk": c, "lang": lang, "df": 2, "docs": [10 * k, 10 * k + 1], "sources": [x, "z"], "counts": [k, 2]}
        for k, (c, lang, x) in enumerate(
            (c, lang, x) for c in (b"a", b"b-a", b"c") for lang in ("de", "en") for x in "xyx"
        )
    ]
    whole = pa.Table.from_pylist(rows, source_audit._CHUNKS)
    merge = source_audit.chunk_merger(5)

    def result(size):
        n, most = Counter(), []
        for r in (r for b in merge(iter(whole.to_batches(max_chunksize=size))) for r in b.to_pylist()):
            if r["source"] is None:
                most.append((r["lang"], r["term"], r["df"], r["docs"]))
            else:
                n[r["lang"], r["source"], r["term"]] += r["n"]
        return n, sorted(most)

    assert result(1) == result(2) == result(5) == result(100)
    n, most = result(100)
    assert {r[2] for r in most} == {6} and all(r[3] == [] for r in most)
    assert n["de", "z", "a"] == 12 and n["en", "y", "c"] == 16
