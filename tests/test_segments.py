"""Logs in merged segments."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of, utc
from wattlane.segments import FAN, Segment, Segments, live, to_merge

SCHEMA = "run string, at timestamp"


def log_of(spark, path, **options):
    schema = spark.createDataFrame([], SCHEMA).schema
    return Segments(spark, str(path / "log"), schema, newest_by="at", sort_by=("at",), **options)


def row(spark, n, minute=None):
    moment = utc(f"2025-11-14T00:{n if minute is None else minute:02d}:00")
    return spark.createDataFrame([(f"run{n}", moment)], SCHEMA)


def test_ten_thousand_appends_leave_few_segments():
    spans, most, rewritten = [], 0, 0
    for _ in range(10_000):
        spans.append(1)
        count = to_merge(spans)
        if count:
            rewritten += sum(spans[-count:])
            spans[-count:] = [sum(spans[-count:])]
        most = max(most, len(spans))
    assert sum(spans) == 10_000
    assert most <= (FAN - 1) * 5 and rewritten <= 10_000 * 5


@pytest.mark.parametrize("fan", [2, 3, 8])
def test_merges_take_what_would_follow_along(fan):
    spans = [fan**3] * (fan - 1) + [fan**2] * (fan - 1) + [fan] * (fan - 1) + [1] * fan
    assert to_merge(spans, fan) == len(spans)
    assert to_merge(spans[:-1], fan) == 0


def test_a_merged_segment_hides_what_it_holds():
    names = [Segment(0, 0, 5), Segment(1, 1, None), Segment(0, 1, 5), Segment(2, 2, -7), Segment(3, 3, 9)]
    random.Random(2).shuffle(names)
    assert live(names) == [Segment(0, 1, 5), Segment(2, 2, -7), Segment(3, 3, 9)]
    assert [Segment.of(s.name) for s in names] == names
    assert Segment.of("_unfinished-0") is None and Segment.of("_SUCCESS") is None


def test_appends_are_all_read_and_the_newest_from_one_file(spark, tmp_path):
    log = log_of(spark, tmp_path, fan=3)
    log.create()
    assert log.read().count() == 0 and log.newest().count() == 0
    order = [4, 1, 9, 3, 0, 8, 2, 7, 5, 6, 10]
    for n in order:
        log.append(row(spark, n))
        newest = log.newest()
        assert len(newest.inputFiles()) == 1
        seen = order[: order.index(n) + 1]
        assert newest.agg(F.max("run")).first()[0] is not None
        assert f"run{max(seen)}" in {r.run for r in newest.collect()}
    assert sorted(r.run for r in log.read().collect()) == sorted(f"run{n}" for n in order)
    assert len(log.segments()) <= 4


def test_equal_times_go_to_the_last_append(spark, tmp_path):
    log = log_of(spark, tmp_path)
    for n in range(3):
        log.append(row(spark, n, minute=0))
    assert [r.run for r in log.newest().collect()] == ["run2"]


def test_a_writer_may_stop_anywhere(spark, tmp_path, monkeypatch):
    log = log_of(spark, tmp_path, fan=3)
    log.append(row(spark, 0))
    log.append(row(spark, 1))
    # Before its segment is in place: nothing of it is read, and the next append clears it away.
    (tmp_path / "log" / "_unfinished-x").mkdir()
    assert log.read().count() == 2
    # After an append, before the merge that is due.
    with monkeypatch.context() as stop:
        stop.setattr(Segments, "merge", lambda *_: (_ for _ in ()).throw(InterruptedError()))
        with pytest.raises(InterruptedError):
            log.append(row(spark, 2))
    assert log.read().count() == 3 and not (tmp_path / "log" / "_unfinished-x").exists()
    before = log.read()
    log.merge(3)
    # A reader that listed the table before still reads what it listed.
    assert before.count() == log.read().count() == 3 and len(log.segments()) == 1
    log.append(row(spark, 3))
    assert log.read().count() == 4
    assert sum(p.name.startswith("segment") for p in (tmp_path / "log").iterdir()) == 2


def test_replaced_rows_are_gone(spark, tmp_path):
    log = log_of(spark, tmp_path)
    for n in range(3):
        log.append(row(spark, n))
    log.replace(row(spark, 7))
    log.append(row(spark, 8))
    assert sorted(r.run for r in log.read().collect()) == ["run7", "run8"]


def test_merges_keep_the_last_entry_of_a_key(spark, tmp_path):
    schema = spark.createDataFrame([], "key string, part int, entry long, value string").schema
    log = Segments(spark, str(tmp_path / "keyed"), schema, keys=("key", "part"), fan=2)
    for n in range(4):
        rows = [("a", None, n, f"a{n}"), (f"k{n % 2}", 1, n, f"k{n}")]
        log.append(spark.createDataFrame(rows, schema))
    assert len(log.segments()) == 1
    assert rows_of(log.read(), "key", "entry", "value") == [("a", 3, "a3"), ("k0", 2, "k2"), ("k1", 3, "k3")]
