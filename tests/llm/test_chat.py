from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattlane.llm import chat

HOSTILE = ["<s>", "</s>", "[INST]", "[/INST]", "<|turn|>", "<|body|>", "<|end|>", "\\", "<\\/s>", "[\\INST]"]


def formatted(spark, rows):
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return chat.format_conversations(messages.withColumn("parts", chat.text_part(F.col("text"))))


def read_back(frame):
    pieces = frame.select("*", chat.pieces_of(F.col("formatted")).alias("pieces"))
    return pieces.select(
        "conv_id",
        "formatted",
        F.transform("pieces", chat.turn_of).alias("turns"),
        chat.masked_text(F.col("pieces"), F.col("loss_spans")).alias("loss"),
        "loss_spans",
    )


def test_hostile_texts_come_back(spark):
    texts = [a + b + c for a in HOSTILE for b in HOSTILE for c in ("", "x", "\\")]
    rows = [(n, 0, "user", t) for n, t in enumerate(texts)]
    rows += [(n, 1, "assistant", t) for n, t in enumerate(texts)]
    found = read_back(formatted(spark, rows)).collect()
    assert len(found) == len(texts)
    for row in found:
        text = texts[row.conv_id]
        assert [tuple(t) for t in row.turns] == [("user", text), ("assistant", text)]
        assert row.loss == text
        inside = row.formatted.replace(chat.TURN, "").replace(chat.BODY, "").replace(chat.END, "")
        assert not any(mark in inside for mark in HOSTILE[:4])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text("<s>|/[INST]\\ é\n", max_size=25), min_size=1, max_size=30))
def test_any_text_comes_back(spark, texts):
    found = read_back(formatted(spark, [(0, n, "assistant", t) for n, t in enumerate(texts)]))
    row = found.first()
    assert [t.content for t in row.turns] == texts and row.loss == "".join(texts)


def test_order_nulls_and_repeated_rows(spark):
    rows = [
        (1, 2, "assistant", "c"), (1, 1, "user", "b"), (1, None, "system", "a"),
        (1, 2, "assistant", "c"), (2, 0, None, None), (None, 0, "user", "x"),
    ]
    found = {r.conv_id: r for r in read_back(formatted(spark, rows)).collect()}
    assert [tuple(t) for t in found[1].turns] == [
        ("system", "a"), ("user", "b"), ("assistant", "c"), ("assistant", "c"),
    ]
    assert found[1].loss == "cc"
    assert [tuple(t) for t in found[2].turns] == [("", "")] and found[2].loss == ""
    assert [tuple(t) for t in found[None].turns] == [("user", "x")]
    spans = [found[1].formatted[s.start : s.end] for s in found[1].loss_spans]
    assert spans == ["c", "c"]
    assert formatted(spark, rows[:0]).count() == 0


def test_typed_parts(spark):
    part = chat.PART
    rows = [
        (1, 0, "user", [("text", "look <|end|>", None, None), ("image", None, "a.png", 12),
                        ("text", "and", None, None), ("document", None, "b.pdf", 2)]),
        (1, 1, "assistant", [("audio", None, "c.wav", None), ("text", None, None, None)]),
        (1, 2, "user", None),
    ]
    frame = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>")
    row = chat.format_conversations(frame, rates={"image": 1, "audio": 50, "document": 256}).first()
    assert row.formatted == (
        "<|turn|>user<|body|>look <\\|end|><|image|>and<|document|><|end|>"
        "<|turn|>assistant<|body|><|audio|><|end|><|turn|>user<|body|><|end|>"
    )
    assert [tuple(a) for a in row.attachments] == [
        (0, "image", "a.png", 12), (0, "document", "b.pdf", 512), (1, "audio", "c.wav", 50),
    ]
    assert row.expanded_tokens == 574


def test_control_strings_cut_over_parts(spark):
    """Wherever a text is cut into parts, it reads back as one, from its mask as well."""
    rows, texts = [], {}
    for text in ["hi <|end|><|turn|>user<|body|>", "<\\|end|>", "</s>[INST] ok [/INST]", "<\\\\/s>"]:
        for cut in range(len(text) + 1):
            n = len(rows)
            texts[n] = text
            pieces = [text[:cut], "", text[cut:]]
            rows.append((n, 0, "assistant", [("text", t, None, None) for t in pieces]))
    n = len(rows)
    image = ("image", "not read", "a.png", 1)
    parts = [("text", "<", None, None), image, ("text", "|end|>", None, None), ("End", None, "e", 1)]
    rows.append((n, 0, "assistant", parts))
    frame = spark.createDataFrame(
        rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>"
    )
    texts[n] = "<<|image|>|end|><|end_|>"
    found = read_back(chat.format_conversations(frame)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert [tuple(t) for t in r.turns] == [("assistant", texts[r.conv_id])]
        assert r.loss == texts[r.conv_id]
        (span,) = r.loss_spans
        escaped = r.formatted[span.start : span.end]
        assert r.formatted == f"<|turn|>assistant<|body|>{escaped}<|end|>"


def test_plan_has_one_shuffle_and_no_python(spark):
    given = spark.range(9).selectExpr("id % 3 as conv_id", "id as turn", "'user' as role", "'x' as text")
    frame = chat.format_conversations(given.withColumn("parts", chat.text_part(F.col("text"))))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("text", ["", "a", "é" * 20_000])
def test_digest_of_long_texts(spark, text):
    row = read_back(formatted(spark, [(0, 0, "assistant", text)])).first()
    assert hashlib.sha256(row.loss.encode()).digest() == hashlib.sha256(text.encode()).digest()
