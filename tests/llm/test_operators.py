"""Operators against brute force, over awkward rows and over nothing."""

from __future__ import annotations

import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import awkward_rows
from wattlane.llm import (
    digest,
    golay_simhash,
    line_windows,
    mixing,
    ordinal,
    pieces,
    recompression,
    repetition,
    suffix_array,
    textarrays,
)
from wattlane.llm.queries import PIECE_MODEL, tokenizer_path

ROWS = [(r[0], r[1]) for r in awkward_rows()]
UNIQUE = [r for n, r in enumerate(awkward_rows()) if r[0] is not None and n < 18]


def keyed(frame, *columns):
    return Counter(tuple(r) for r in frame.select(*columns).collect())


def test_line_dedup(awkward, frame, nothing):
    found = line_windows.dedup_lines(frame(UNIQUE)).collect()
    expected = brute.line_dedup([(r[0], r[1]) for r in UNIQUE])
    assert {r.doc_id: (r.n_lines, len(r.removed), r.kept_text) for r in found} == expected
    every = line_windows.dedup_lines(awkward).collect()
    assert len(every) == len(ROWS)
    assert len({(r.kept_text, len(r.removed)) for r in every if r.doc_id == 1}) == 1
    assert line_windows.dedup_lines(nothing).count() == 0


def test_line_dedup_removes_overlapping_later_windows(frame):
    a, b = "a one\nb two\nc three\nd four", "x\na one\nb two\nc three\nd four\ny"
    rows = [(2, b, None, None, None), (1, a, None, None, None), (3, a, None, None, None)]
    found = {r.doc_id: r.kept_text for r in line_windows.dedup_lines(frame(rows)).collect()}
    assert found == {1: a, 2: "x\ny", 3: ""}


@pytest.mark.parametrize("leaf_rows, fan_in", [(4096, 64), (8, 2)])
def test_mixing(spark, leaf_rows, fan_in):
    docs = spark.range(900).select(
        F.col("id").alias("doc_id"),
        F.expr("case when id % 3 = 0 then 'hot' when id % 11 = 0 then null "
               "when id = 7 then 'tiny' else concat('s', id % 5) end").alias("source"),
        F.expr("repeat('w ', cast(pmod(hash(id), 40) as int))").alias("text"),
    )
    run = lambda: mixing.mix(docs, leaf_rows=leaf_rows, fan_in=fan_in).collect()
    rows = run()
    assert len(rows) == 900
    assert sorted(map(repr, rows)) == sorted(map(repr, run()))
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.copies * r.size
        largest[r.source] = max(largest[r.source], r.size)
        assert 0 <= r.copies <= 3
    expected = brute.targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
    for source, target in expected.items():
        assert abs(taken[source] - target) <= largest[source] + 1e-6


def test_mixing_of_awkward_rows(awkward, nothing):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == len(ROWS)
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in ROWS)
    assert mixing.mix(nothing).count() == 0


def test_mixing_of_many_equal_rows(spark):
    """20,000 rows of one id, and as many of a null id, are no leaf of their own size."""
    equal = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, 7).cast("long").alias("doc_id"),
        F.lit("hot").alias("source"),
        F.lit("w w w").alias("text"),
    )
    other = spark.range(300).select(
        (F.col("id") + 100).alias("doc_id"), F.lit("rare").alias("source"), F.lit("w w").alias("text")
    )
    docs = equal.unionByName(other)

    def run(rows):
        mixed = mixing.mix(rows, leaf_rows=256, fan_in=4)
        found = mixed.groupBy("doc_id", "source", "copies").count().collect()
        return Counter({(r.doc_id, r.source, r.copies): r["count"] for r in found})

    found = run(docs)
    assert found == run(docs.repartition(3))
    assert sum(found.values()) == 40_300
    targets = brute.targets({"hot": 120_000, "rare": 600})
    for source, size in (("hot", 3), ("rare", 2)):
        taken = sum(size * c * n for (_, s, c), n in found.items() if s == source)
        assert abs(taken - targets[source]) <= size
    for doc_id in (7, None):
        shares = {c for i, s, c in found if s == "hot" and i == doc_id}
        assert len(shares) <= 2 and max(shares) - min(shares) <= 1


def test_pivot_keeps_mass_and_probabilities():
    sizes, parts = np.array([3.0, 5.0, 2.0, 7.0, 1.0]), np.full(5, 0.4)
    seen = np.zeros(5)
    for seed in range(4000):
        x, held = mixing.pivot(sizes, parts, np.random.default_rng(seed).random(6))
        assert (sizes * x).sum() == pytest.approx((sizes * parts).sum())
        assert sum(0 < v < 1 for v in x) == (held is not None)
        seen += x
    assert np.allclose(seen / 4000, 0.4, atol=0.04)


@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_MODEL))


def test_encoding_is_the_library_s(awkward, nothing, library):
    path = tokenizer_path(PIECE_MODEL)
    encoded = pieces.encode_documents(awkward, path, keep=["text"])
    rows = encoded.collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        ids = library.encode(r.text or "", add_eos=True)
        assert list(r.ids) == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == brute.sha(" ".join(map(str, ids)))
        assert r.decoded_sha256 == brute.sha(library.decode(ids))
    back = pieces.decode_documents(encoded, path)
    assert keyed(back, "doc_id", "text") == Counter((i, t or "") for i, t in ROWS)
    assert pieces.encode_documents(nothing, path).count() == 0


def test_encoding_of_random_texts(library):
    tool = pieces.PieceCodec(tokenizer_path(PIECE_MODEL))
    rng = np.random.default_rng(5)
    sets = [" ab", " \n\ta.;)", "▁ a", "the of ingnd ", "éè日本\U0001f600　x", "\r;) \n{}", "aaaaab "]
    for n in range(3000):
        letters = sets[n % len(sets)]
        text = "".join(letters[k] for k in rng.integers(0, len(letters), rng.integers(0, 60)))
        ids = library.encode(text, add_eos=True)
        assert tool.encode(text) == ids, text
        assert tool.decode(ids) == library.decode(ids), text
        any_ids = rng.integers(0, 400, 20).tolist()
        assert tool.decode(any_ids) == library.decode(any_ids)
    for n in range(70):
        assert tool.encode(" " * n + "a") == library.encode(" " * n + "a", add_eos=True)


def test_texts_are_coded_as_the_library_does(library):
    tool = pieces.PieceCodec(tokenizer_path(PIECE_MODEL))
    rng = np.random.default_rng(6)
    sets = ["abcdefgilmnorstuéß", "ñosuéíqz,.$%|#", "▁ te\nth,.日\U0001f600", "ßéèüя本 ."]
    for n in range(400):
        letters = sets[n % len(sets)]
        text = "".join(letters[k] for k in rng.integers(0, len(letters), rng.integers(0, 400)))
        ids = library.encode(text, add_eos=True)
        assert tool.coded(text) == (" ".join(map(str, ids)), library.decode(ids)), text


def test_pairs_are_judged_as_merging_again_does():
    tool = pieces.PieceCodec(tokenizer_path(PIECE_MODEL))
    rng, known = np.random.default_rng(7), list(tool._shorter)
    pairs = [(known[i], known[k]) for i, k in rng.integers(0, len(known), (5000, 2))]
    # Cuts of a piece: some are its last merge, some do not go together, some do.
    pairs += [(w[:1], w[1:]) for w in known[:5000] if w[1:] in tool._shorter]
    judged = [tool._go_together(pair) for pair in pairs]
    assert judged == [tool._merged("".join(pair))[0] == [*pair] for pair in pairs]
    assert len({*judged}) == 2


def test_a_word_is_searched_once_whatever_follows_and_no_pair_is_merged_again(library):
    tool = pieces.PieceCodec(tokenizer_path(PIECE_MODEL))
    text = " ".join(f"stedthanging{end}" for end in ("", ",", ".", "!", "$$$", ",%%", "\nlo"))
    ids = library.encode(text, add_eos=True)
    searched, search = [], tool._tokens

    def no_merging(_):
        raise AssertionError("merged again")

    def noted(chunk):
        searched.append(chunk)
        return search(chunk)

    tool._merged, tool._tokens = no_merging, noted
    assert tool.encode(text) == ids
    assert [chunk for chunk in searched if "stedthanging" in chunk] == ["▁stedthanging"]


def test_long_text_without_a_space_takes_linear_time(library):
    tool = pieces.codec(tokenizer_path(PIECE_MODEL))
    rng = np.random.default_rng(8)
    text = "".join(rng.choice(list("abcdefgilmnorstuéß"), 160_000))
    begun = time.process_time()
    ids = tool.encode(text)
    assert time.process_time() - begun < 10  # a fifth of it here; minutes where it is quadratic
    assert ids == library.encode(text, add_eos=True)


def test_repetition_rules(awkward, nothing):
    found = repetition.repetition_rules(awkward)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    expected = Counter((i, *brute.repetition(t)) for i, t in ROWS)
    assert keyed(found, "doc_id", *names) == expected
    kept = {r.doc_id: (r.base_failed, r.kept) for r in found.collect() if r.doc_id not in (2, None)}
    assert kept[1] == (False, True) and kept[15] == (False, True)
    assert kept[10] == (True, False) and kept[9] == (True, False)
    assert repetition.repetition_rules(nothing).count() == 0


def test_repetition_covers_characters_of_longer_grams(frame):
    piece = " ".join(f"unlike{k}" for k in range(12))
    rest = " ".join(f"other{k}" for k in range(60))
    rows = [(1, f"{piece} {rest} {piece}", None, None, None), (2, f"{piece} {rest}", None, None, None)]
    found = {r.doc_id: r for r in repetition.repetition_rules(frame(rows)).collect()}
    assert found[1].dup_10_chars == 2 * len(piece.replace(" ", ""))
    assert (found[1].base_failed, found[1].kept) == (False, False)
    assert found[2].dup_5_chars == 0 and found[2].kept


def thue_morse(n, first, second):
    """Of this sequence and its complement all polynomials modulo a power of two agree."""
    turns = [bin(k).count("1") & 1 for k in range(n)]
    return [(first, second)[k] for k in turns], [(second, first)[k] for k in turns]


def test_hashes_are_of_the_content():
    numbers = np.random.default_rng(5).integers(0, 2**63, 3000, dtype=np.uint64)
    prime = 2**61 - 1
    a, b = numbers % prime, numbers[::-1] % prime
    assert textarrays.times(a, b).tolist() == [int(x) * int(y) % prime for x, y in zip(a, b, strict=True)]
    twice = textarrays.RangeHashes(np.concatenate([numbers, numbers[:7], numbers]))
    at = np.arange(2000)
    assert (twice(at, at + 900) == twice(at + 3007, at + 3907)).all()
    assert len(np.unique(twice(at, at + 900))) == 2000
    data = (numbers % 256).astype(np.uint8)
    spans = textarrays.byte_hashes(np.concatenate([data, data]), at, at + 1000)
    again = textarrays.byte_hashes(np.concatenate([data, data]), at + 3000, at + 4000)
    assert (spans == again).all() and len(np.unique(spans)) == 2000
    one, other = (np.array(x, np.uint64) for x in thue_morse(4096, 17, 40))
    hashes = textarrays.RangeHashes(np.concatenate([one, other]))
    assert hashes(np.array([0]), np.array([4096])) != hashes(np.array([4096]), np.array([8192]))


def test_crafted_words_lines_and_stretches_stay_apart(spark):
    one, other = ("".join(x) for x in thue_morse(2048, "a", "b"))
    words, swapped = (" ".join(x) for x in thue_morse(4096, "ab", "ba"))
    tail = [f"t{k}" for k in range(28)]
    docs = [
        (1, f"{one}\n{other}"),
        (2, " ".join([*tail, one, *tail])),
        (3, " ".join([*tail, other, *tail])),
        (4, words),
        (5, swapped),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rules = {r.doc_id: r for r in repetition.repetition_rules(frame).collect()}
    assert rules[1].n_dup_lines == 0
    found = recompression.dedup_substrings(frame)
    expected = Counter((i, *a) for (i, _), a in zip(docs, brute.earlier_windows(docs, 50), strict=True))
    assert keyed(found, "doc_id", "n_words", "n_removed", "kept_text") == expected
    long = [(1, one), (2, other), (3, one[:900]), (4, "zz" + one[:2048])]
    frame = spark.createDataFrame(long, "doc_id long, text string")
    found = suffix_array.dedup_substrings(frame, width=1300)
    answers = brute.repeated_bytes([t for _, t in long], 1300)
    rows = found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes").collect()
    assert Counter((*r[:4], bytes(r[4])) for r in rows) == Counter(
        (i, *a) for (i, _), a in zip(long, answers, strict=True)
    )


@pytest.mark.parametrize("in_one_task", [256, 1])
def test_repeated_bytes(awkward, nothing, in_one_task):
    found = suffix_array.dedup_substrings(awkward, width=60, gram=16, in_one_task=in_one_task)
    answers = brute.repeated_bytes([t for _, t in ROWS], 60)
    expected = Counter((i, *a) for (i, _), a in zip(ROWS, answers, strict=True))
    rows = found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes").collect()
    assert Counter((*r[:4], bytes(r[4])) for r in rows) == expected
    assert suffix_array.dedup_substrings(nothing).count() == 0


def test_repeats_among_many_unlike_near_copies(spark):
    """Each copy of a passage is changed somewhere, so one gram has many classes."""
    rng = np.random.default_rng(5)
    passage = "".join(chr(97 + k) for k in rng.integers(0, 26, 300))
    docs = []
    for n in range(700):
        text = list(passage)
        for at in rng.integers(0, len(text), rng.integers(1, 3)):
            text[at] = chr(65 + rng.integers(0, 26))
        docs.append((n, f"{n:05d}" * 3 + "".join(text) + f"{n * 31:06d}" * 3))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = suffix_array.dedup_substrings(frame, width=120, gram=16, in_one_task=24)
    answers = brute.repeated_bytes([t for _, t in docs], 120)
    rows = found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes").collect()
    assert Counter((*r[:4], bytes(r[4])) for r in rows) == Counter(
        (i, *a) for (i, _), a in zip(docs, answers, strict=True)
    )


def test_maximal_repeats_have_all_occurrences():
    texts = [b"xxABCDEFGHyy", b"zzABCDEFGHww", b"qqABCDEFGHyk", b"kkQBCDEFGQmm"]
    anchored = sorted((t[6:], t[:6][::-1]) for t in texts)  # anchor before the E
    right, left = [a for a, _ in anchored], [b for _, b in anchored]
    found = {
        (left[m[0]][:reach][::-1] + right[m[0]][:depth], len(m))
        for reach, depth, m in suffix_array.maximal_repeats(left, right, 4)
    }
    assert found == {(b"ABCDEFGH", 3), (b"ABCDEFGHy", 2), (b"BCDEFG", 4)}


def test_windows_of_earlier_documents(awkward, nothing):
    found = recompression.dedup_substrings(awkward, width=20, rounds=2)
    answers = brute.earlier_windows(ROWS, 20)
    expected = Counter((i, *a) for (i, _), a in zip(ROWS, answers, strict=True))
    assert keyed(found, "doc_id", "n_words", "n_removed", "kept_text") == expected
    assert recompression.dedup_substrings(nothing).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_substrings_of_few_words(spark, seed):
    """Small alphabets make runs, ties and periods everywhere."""
    rng = np.random.default_rng(seed)
    words = ["a", "b", "cc", "dé"][: 2 + seed % 3]
    docs = []
    for n in range(60):
        base = [words[k] for k in rng.integers(0, len(words), rng.integers(0, 90))]
        if n % 3 and docs:
            other = docs[rng.integers(0, len(docs))][1].split()
            base = base[:10] + other[rng.integers(0, 5) :] + base[10:20]
        docs.append((int(rng.integers(0, 40)), " ".join(base)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = recompression.dedup_substrings(frame, width=12, rounds=2)
    expected = Counter((i, *a) for (i, _), a in zip(docs, brute.earlier_windows(docs, 12), strict=True))
    assert keyed(found, "doc_id", "n_words", "n_removed", "kept_text") == expected
    found = suffix_array.dedup_substrings(frame, width=24, gram=6, in_one_task=3 if seed % 2 else 256)
    answers = brute.repeated_bytes([t for _, t in docs], 24)
    rows = found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes").collect()
    assert Counter((*r[:4], bytes(r[4])) for r in rows) == Counter(
        (i, *a) for (i, _), a in zip(docs, answers, strict=True)
    )


def test_near_components(awkward, nothing):
    found = golay_simhash.near_dedup(awkward)
    expected = Counter(
        (i, f"{p:016x}", c) for (i, _), (p, c) in zip(ROWS, brute.near_components(ROWS), strict=True)
    )
    assert keyed(found, "doc_id", "fingerprint", "component_id") == expected
    assert golay_simhash.near_dedup(nothing).count() == 0


def test_chains_of_prints_are_one_component(spark):
    rng = np.random.default_rng(3)
    prints, root = [], []
    for chain in range(40):
        x = int(rng.integers(0, 2**63))
        for _ in range(int(rng.integers(1, 30))):
            prints.append(x)
            root.append(chain)
            for bit in rng.choice(64, 3, replace=False):
                x ^= 1 << int(bit)
    signed = np.array(prints, np.uint64).view(np.int64)
    rows = [(n, int(p)) for n, p in enumerate(signed)]
    frame = spark.createDataFrame(rows, "doc_id long, print long")
    groups = {r.print: r.component_id for r in golay_simhash.near_groups(frame).collect()}
    least = {}
    for n, chain in enumerate(root):
        least.setdefault(chain, n)
    assert all(groups[int(p)] == least[chain] for p, chain in zip(signed, root, strict=True))


def test_code_is_perfect_and_near_prints_share_keys():
    sizes = np.bincount(golay_simhash.codes())
    assert len(sizes) == 4096 and (sizes == 2048).all()
    rng = np.random.default_rng(1)
    one = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    other = one.copy()
    for _ in range(3):
        other ^= np.uint64(1) << rng.integers(0, 64, len(one)).astype(np.uint64)
    key, looked, whose = golay_simhash.keys_of(one)
    filed = set(zip(key[looked == 0].tolist(), whose[looked == 0].tolist(), strict=True))
    key, looked, whose = golay_simhash.keys_of(other)
    asked = defaultdict(list)
    for k, w in zip(key[looked == 1].tolist(), whose[looked == 1].tolist(), strict=True):
        asked[w].append(k)
    for a, b in zip(one.tolist(), other.tolist(), strict=True):
        assert any((k, a) in filed for k in asked[b])


def test_digest_levels_are_the_entropies():
    data = np.random.default_rng(0).integers(97, 110, 3000).astype(np.uint8)
    data[200:300] = 97
    found = digest.levels(data)
    for at in range(0, len(data) - 63, 7):
        counts = Counter(data[at : at + 64].tolist())
        entropy = -sum(c / 64 * np.log2(c / 64) for c in counts.values())
        assert abs(found[at] - 1000 * entropy / 6) < 1.01


def test_digests(awkward, nothing):
    ranks = digest.entropy_ranks(awkward)
    rows = digest.against_next(awkward, ranks, stretch_rows=3).collect()
    assert len(rows) == len(ROWS)
    last_first = sorted(
        ((i, t or "") for i, t in ROWS), key=lambda r: (r[0] is not None, r[0] or 0), reverse=True
    )
    following = {}
    for (i, t), (_, u) in zip(last_first, last_first[1:] + last_first[:1], strict=True):
        following.setdefault(i, []).append((t, u))
    for r in rows:
        if len(following[r.doc_id]) > 1:
            continue  # equal ids follow each other by a hash
        (text, after), half = following[r.doc_id][0], 0
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r.n_chars == len(text)
        if len(following.get(r.doc_id - 1, [None])) == 1:
            assert r.edited_sha256 == brute.sha(edited)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    alone = {r.doc_id: r.fingerprint for r in digest.digests(awkward, ranks).collect()}
    assert all(alone[r.doc_id] == r.fingerprint for r in rows if r.doc_id not in (2, None))
    assert digest.against_next(nothing, digest.entropy_ranks(nothing)).count() == 0
    one = digest.from_text(alone[1])
    assert digest.likeness(one, one) == 1.0
    assert digest.likeness(one, digest.from_text(alone[3])) > 0.5
    assert digest.likeness(one, digest.from_text(alone[15])) < 0.2


def test_classifier_learns_order_and_keeps_clean(spark, awkward, nothing):
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(400)]
    rows, labels = [], []
    for n in range(900):
        text = list(rng.choice(words, 60))
        grade = (2, 2, 1, 0)[n % 4]
        if grade == 1:
            text[int(rng.integers(0, 60))] = "vile"
        if grade == 0:
            text = [w + "!!" for w in text]
        rows.append((n, " ".join(text)))
        if n < 600:
            labels.append((n, 0 if grade == 0 else 1, int(grade == 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rated = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    held = [r for r in ordinal.classify(docs, rated).collect() if r.doc_id >= 600]
    right = sum(r.kept == (r.doc_id % 4 < 2) for r in held)
    assert right >= 0.97 * len(held)
    by_grade = [np.mean([r.expected_grade for r in held if (2, 2, 1, 0)[r.doc_id % 4] == g]) for g in range(3)]
    assert by_grade == sorted(by_grade)
    none = rated.limit(0)
    assert {(r.kept, r.expected_grade) for r in ordinal.classify(awkward, none).collect()} == {(True, None)}
    odd = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (4, None, 1), (None, 1, 0)], rated.schema)
    assert ordinal.classify(awkward, odd).count() == len(ROWS)
    assert ordinal.classify(nothing, rated).count() == 0


def test_null_flags_are_no_rating(spark):
    flags = [(0, 0, 0), (0, None, 0), (1, 1, 1), (1, 0, 2), (1, None, None), (None, 0, None), (None, 1, None)]
    frame = spark.createDataFrame(flags, "quality int, toxic int, grade int")
    wrong = frame.where(~ordinal.grade_of(F.col("quality"), F.col("toxic")).eqNullSafe(F.col("grade")))
    assert wrong.count() == 0


def test_a_labelled_id_on_many_rows_is_one_text(spark):
    """Its rows neither reach the driver nor outweigh the others; grades may be any."""
    good, bad = "plain words of a text ", "foul words of a text "
    base = spark.createDataFrame(
        [(n, (good, bad)[n % 2] + f"number{n}") for n in range(400)], "doc_id long, text string"
    )
    crowd = spark.range(20_000).selectExpr("0L as doc_id", f"'{bad}' || id % 3 as text")
    ratings = spark.createDataFrame([(n, (5, 2)[n % 2]) for n in range(400)], "doc_id long, grade int")
    model = ordinal.fitted(base.union(crowd), ratings)
    assert model.grades.tolist() == [2, 5]
    tail = {r.doc_id: r.tail_probability for r in ordinal.graded(base, model).collect()}
    assert all((tail[n] > 0.5) == (n % 2 == 0) for n in range(400))
    assert ordinal.fitted(base, ratings.limit(0)) is None


def test_digest_over_many_stretches(spark):
    """A thousand stretches answer as one does, null and equal ids among them."""
    rows = [(None if k % 7 == 0 else k - k % 5, f"text {k} " + "word " * (k % 9)) for k in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    ranks = digest.entropy_ranks(docs)

    def result(stretch_rows):
        found = digest.against_next(docs, ranks, stretch_rows=stretch_rows)
        return sorted(map(tuple, found.drop("stretch").collect()), key=repr)

    assert result(5) == result(10**6)
