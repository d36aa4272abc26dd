"""Registered queries over the smallest given tables, and the stages of the pipeline."""

from __future__ import annotations

from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.llm import brute

corpus_pipeline = pytest.importorskip("corpus_pipeline")
duckdb = pytest.importorskip("duckdb")

from wattlane.llm import stages  # noqa: E402
from wattlane.llm.queries import ORACLES, PIECE_MODEL, QUERIES, tokenizer_path  # noqa: E402

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    return sorted(((r.doc_id, r.text, r.source) for r in rows), key=lambda r: r[0])


def rows_of(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, SMALL).collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_agrees(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations", "pages", "labels"):
        connection.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    expected = connection.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    found = QUERIES[name](spark, SMALL)
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(expected.fetchall())


def test_mixing(spark, docs):
    found = rows_of(spark, "op3_mixing")
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for doc_id, text, source in docs:
        size = len(brute.WORD.findall(text or ""))
        assert found[doc_id].size == size and found[doc_id].taken <= 3 * size
        sizes[source] += size
        taken[source] += found[doc_id].taken
        largest[source] = max(largest[source], size)
    for source, target in brute.targets(sizes).items():
        assert abs(taken[source] - target) <= largest[source] + 1e-6
        some = next(found[i] for i, _, s in docs if s == source)
        assert some.target == pytest.approx(target) and some.source_size == sizes[source]


def test_sentencepiece(spark, docs):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_MODEL))
    found = rows_of(spark, "op4_sentencepiece")
    for doc_id, text, _ in docs:
        ids = library.encode(text or "", add_eos=True)
        row = found[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == brute.sha(" ".join(map(str, ids)))
        assert row.decoded_sha256 == brute.sha(library.decode(ids))


def test_quality_rules(spark, docs):
    found = rows_of(spark, "op5_quality_rules")
    for doc_id, text, _ in docs:
        row, expected = found[doc_id], brute.repetition(text)
        assert (
            row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words
        ) == expected
        failed = expected[0] < 50 or 100 * expected[4] > 50 * expected[0]
        assert row.base_failed == failed and not (failed and row.kept)


def test_suffix_array(spark, docs):
    found = rows_of(spark, "op6_suffix_array")
    expected = brute.repeated_bytes([t for _, t, _ in docs], 400)
    for (doc_id, _, _), (n_bytes, n_removed, n_spans, kept) in zip(docs, expected, strict=True):
        row = found[doc_id]
        assert (row.n_bytes, row.n_removed, row.n_spans) == (n_bytes, n_removed, n_spans)
        assert row.kept_sha256 == brute.sha(kept)


def test_simhash(spark, docs):
    found = rows_of(spark, "op7_simhash")
    expected = brute.near_components([(i, t) for i, t, _ in docs])
    for (doc_id, _, _), (print_, component) in zip(docs, expected, strict=True):
        assert found[doc_id].fingerprint == f"{print_:016x}"
        assert found[doc_id].component_id == component


def test_digest(spark, docs):
    found = rows_of(spark, "op9_digest")
    texts = [t or "" for _, t, _ in docs]
    by_text = defaultdict(set)
    for n, (doc_id, text, _) in enumerate(docs):
        row, text, after = found[doc_id], text or "", texts[n - 1]
        half = len(text) // 2
        assert row.n_chars == len(text)
        assert row.edited_sha256 == brute.sha(text[: len(text) - half] + after[:half])
        by_text[text].add(row.fingerprint)
        if text == after:
            assert row.near_next == 1.0
    assert all(len(prints) == 1 for prints in by_text.values())
    assert sum(r.near_edited > r.near_next for r in found.values()) > 0.9 * len(found)


def test_recompression(spark, docs):
    found = rows_of(spark, "op10_recompression")
    expected = brute.earlier_windows([(i, t) for i, t, _ in docs], 50)
    for (doc_id, _, _), (n_words, n_removed, kept) in zip(docs, expected, strict=True):
        row = found[doc_id]
        assert (row.n_words, row.n_removed, row.kept_sha256) == (n_words, n_removed, brute.sha(kept))


def test_classifier_on_texts_it_was_not_fitted_on(spark, tmp_path):
    """Labels of every second document fit the model; the others judge it."""
    given = "/root/testdata/sf0.1"
    if not Path(given).exists():
        pytest.skip("the given tables are not here")
    from wattlane.llm import ordinal

    docs = spark.read.parquet(f"{given}/documents.parquet")
    labels = spark.read.parquet(f"{given}/labels.parquet")
    found = ordinal.classify(docs, labels.where("doc_id % 2 = 0"))
    judged = found.join(labels.where("doc_id % 2 = 1"), "doc_id").select(
        "kept", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("clean")
    )
    count = {(r.clean, r.kept): r["count"] for r in judged.groupBy("clean", "kept").count().collect()}
    assert count[True, True] >= 0.99 * (count[True, True] + count.get((True, False), 0))
    assert count[False, False] >= 0.8 * (count[False, False] + count.get((False, True), 0))


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    tables = [spark.read.parquet(f"{SMALL}/documents.parquet")]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], SMALL).write.parquet(f"{folder}/{number}")
        tables.append(spark.read.parquet(f"{folder}/{number}"))
    return tables


def test_stages_keep_columns_and_decide(spark, staged):
    given, classed, lined, deduped, mixed, encoded = staged
    for table in (classed, lined, deduped, mixed):
        assert table.dtypes == given.dtypes
    kept = {r.doc_id for r in QUERIES["op8_quality_classifier"](spark, SMALL).where("kept").collect()}
    assert {r.doc_id for r in classed.collect()} == kept
    expected = brute.line_dedup([(r.doc_id, r.text) for r in classed.collect()])
    found = {r.doc_id: r for r in lined.collect()}
    for doc_id, (_, removed, text) in expected.items():
        if removed and not text.strip():
            assert doc_id not in found
        else:
            assert found[doc_id].text == text
            assert not removed or found[doc_id].n_chars == len(text)
    rows = [(r.doc_id, r.text) for r in found.values()]
    groups = {c for _, c in brute.near_components(rows)}
    assert {r.doc_id for r in deduped.collect()} == groups
    size, taken = defaultdict(int), defaultdict(int)
    largest = 0
    for r in deduped.collect():
        words = len(brute.WORD.findall(r.text or ""))
        size[r.source] += words
        largest = max(largest, words)
    for r in mixed.collect():
        taken[r.source] += len(brute.WORD.findall(r.text or ""))
    for source, target in brute.targets(size).items():
        assert abs(taken[source] - target) <= largest + 1e-6
    assert encoded.count() == mixed.count()
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert all(r.decoded_sha256 == brute.sha(texts[r.doc_id]) for r in encoded.collect())


def test_stages_over_awkward_rows_and_over_nothing(spark, awkward, nothing, tmp_path):
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        found = stage(spark, awkward, SMALL)
        assert found.columns == awkward.columns, name
        found.write.parquet(f"{tmp_path}/{number}")
        assert stage(spark, nothing, SMALL).count() == 0, name
    assert stages.encode(spark, awkward, SMALL).count() == awkward.count()
    near = spark.read.parquet(f"{tmp_path}/2")
    assert near.where("doc_id = 1").count() <= 1


def test_near_stage_with_ids_that_repeat(spark, frame):
    """Unlike texts of one id are documents of their own; of equal rows the least one stays."""
    near = " ".join(f"w{k}" for k in range(400))
    rows = [
        (5, near, "en", "b", 1), (5, near, "en", "a", 1), (5, near, "de", "a", 1), (9, near + " x", "en", "c", 1),
        (5, "another text of this id", "en", "a", 1), (None, None, None, None, None), (7, "", "en", "a", 0),
    ]
    found = stages.dedup_near(spark, frame(rows), SMALL).select("doc_id", "text", "lang", "source")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(5, near, "de", "a"), (5, rows[4][1], "en", "a"), (None, None, None, None)], key=repr
    )


def test_mixing_stage_gives_each_source_its_own(spark, frame):
    """Two sources share ids and texts; each gets what the mix takes of it."""
    rows = [(k, f"text {k} " + "word " * (k % 50), "en", s, 1) for k in range(300) for s in ("s0", "s1")]
    found = stages.mix_sources(spark, frame(rows), SMALL).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len(text.split())
    for r in found:
        taken[r.source] += len(r.text.split())
    for source, target in brute.targets(sizes).items():
        assert abs(taken[source] - target) <= 60


def test_whole_run(spark, staged):
    found = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(repr, found.drop("ids").collect())) == sorted(
        map(repr, staged[-1].drop("ids").collect())
    )
