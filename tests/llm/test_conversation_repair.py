"""Conversation repair against every edit of every row."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from wattlane.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, place string, block string"


def frame_of(spark, rows, parts=2):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(parts)


def found_of(spark, rows, block=repair.BLOCK):
    audit, made = repair.repair(frame_of(spark, rows), block=block)
    lines = defaultdict(list)
    for r in made.orderBy("place", "part").collect():
        lines[r.conv_id].append((r.role, r.text))
    sums = {r.conv_id: r.repaired_sha256 for r in repair.digests(made).collect()}
    out = {}
    for r in audit.collect():
        text = "\n".join(f"{role}:{text}" for role, text in lines[r.conv_id])
        assert sums.get(r.conv_id, brute.sha("")) == brute.sha(text)
        out[r.conv_id] = (
            r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, lines[r.conv_id]
        )
    return out


def expected_of(rows):
    by = defaultdict(list)
    for conv_id, turn, role, text in rows:
        by[conv_id].append((turn, role, text))
    return {conv_id: brute.repaired(own) for conv_id, own in by.items()}


def made_up(seed, conversations=60, most=14):
    rng = random.Random(seed)
    rows = []
    for conv_id in range(conversations):
        for turn in range(rng.randrange(1, most)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "half", "Well, \n", "", " \t", None, f"Turn {turn}?", f"turn {turn}"])
            rows.append((conv_id, rng.choice([turn, turn, turn, None, 0, 3]), role, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = made_up(seed)
    assert found_of(spark, rows) == expected_of(rows)


def test_conversations_over_many_blocks(spark):
    """Blocks of four rows: matrices and states are handed on from block to block."""
    rows = made_up(5, conversations=12, most=40)
    assert found_of(spark, rows, block=4) == expected_of(rows)


def test_awkward_rows(spark):
    rows = [
        (None, 1, "user", "A null id."), (None, None, "assistant", "Its first."),
        (1, 1, "user", "same.") , (1, 1, "user", "same."), (1, 1, "user", "same."),
        (2, 5, None, None), (3, -4, "system", "Only a system row."), (4, 1, "", "No role."),
        (5, 9_000_000_000_000_000_000, "user", "Far."), (5, -9_000_000_000_000_000_000, "user", "apart"),
        (6, 1, "user", "é" * 200_000 + "."), (6, 2, "assistant", "\U0001f600 !"),
    ]
    found, expected = found_of(spark, rows), expected_of(rows)
    assert found.pop(5)[1:] == expected.pop(5)[1:]  # the gap is wider than 64 bits hold
    assert found == expected


def test_one_conversation_of_many_equal_rows(spark):
    """Copies are one run, whatever their number; ties of all kinds in one turn."""
    rows = [(1, 0, "user", "Ask.")] * 3000 + [(1, 1, "user", f"Turn {k}.") for k in range(300)]
    found = found_of(spark, rows, block=64)
    assert found == expected_of(rows)
    assert found[1][6].count("D") >= 2999


def test_nothing(spark):
    audit, rows = repair.repair(frame_of(spark, []))
    assert audit.count() == rows.count() == repair.digests(rows).count() == 0


def test_powers_are_products():
    """A run of n rows equals n steps, for every symbol."""
    for symbol in (0, 1, 2, 3, 4, 5, 6, 7, repair.DELETED):
        step = repair.power(symbol, 0)
        slow = repair.UNIT
        for n in range(1, 20):
            slow = repair._times(slow, step)
            assert repair.run_matrix([(symbol, n)]) == slow
            assert repair._through(symbol, n, repair.ENDING) == tuple(
                min(slow[p][q] + repair.ENDING[q] for q in range(4)) for p in range(4)
            )


def test_damage(spark):
    """Each kind of damage, by the checksum of conversation and turn."""
    import zlib

    from wattlane.llm.queries import damaged

    rows = [(c, t, "assistant", "A. B! C?") for c in range(40) for t in (None, *range(10))]
    rows += [(None, 1, None, None)]
    found = defaultdict(list)
    for r in damaged(frame_of(spark, rows)).select("conv_id", "turn", F.struct("role", "text")).collect():
        found[r[0], r[1]].append(tuple(r[2]))
    for conv_id, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        own = (" " if role is None else role, " " if text is None else text)
        kind = zlib.crc32(name.encode()) % 20
        expected = {0: [], 1: [(own[0], "")], 2: [(own[0], own[1].translate({46: "", 33: "", 63: ""}))],
                    3: [own, own], 4: [("user", own[1])]}.get(kind, [own])
        assert found[conv_id, turn] == expected
