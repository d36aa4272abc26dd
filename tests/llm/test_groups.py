"""The general output of the suffix-array operator: groups with all their occurrences."""

from __future__ import annotations

from collections import defaultdict

import pytest

from wattlane.llm.common import texts_of
from wattlane.llm.suffix_array import repeat_groups


@pytest.mark.parametrize("in_one_task", [256, 2])
def test_occurrences_of_a_group_read_alike(spark, in_one_task):
    passage = "".join(chr(97 + (k * k) % 26) for k in range(80))
    rows = [(n, f"{n:04d}" * 5 + passage[n % 4 :] + f"{n * 7:04d}" * 6) for n in range(12)]
    texts = texts_of(spark.createDataFrame(rows, "doc_id long, text string"))
    found = repeat_groups(texts, width=40, gram=8, in_one_task=in_one_task).collect()
    by_id, groups = dict(rows), defaultdict(set)
    for r in found:
        words = by_id[r.doc_id][r.low : r.high + 40]
        groups[r.key, r.number, words].add((r.doc_id, r.low))
    if in_one_task == 256:
        assert all(len(places) > 1 for places in groups.values())
    covered = {doc_id for doc_id, *_ in found}
    assert covered == set(by_id)
