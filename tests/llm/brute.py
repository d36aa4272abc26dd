"""Plain Python answers to what the operators compute, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def line_dedup(docs):
    """Documents (id, text) with unlike ids: lines, removed, text left."""
    rows = sorted(((i, t or "") for i, t in docs), key=lambda r: (r[0] is not None, r[0] or 0))
    first, windows = {}, []
    for i, text in rows:
        lines = text.split("\n")
        for at in range(len(lines) - 2):
            window = tuple(lines[at : at + 3])
            if WORD.search("".join(window)):
                first.setdefault(window, (i, at))
                windows.append((i, at, window))
    gone = {}
    for i, at, window in windows:
        if first[window] != (i, at):
            gone.setdefault(i, set()).update(range(at, at + 3))
    out = {}
    for i, text in rows:
        lines = text.split("\n")
        left = [x for n, x in enumerate(lines) if n not in gone.get(i, ())]
        out[i] = (len(lines), len(lines) - len(left), "\n".join(left))
    return out


def repetition(text):
    text = text or ""
    words = WORD.findall(text)
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def repeated_bytes(texts, width):
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[k : k + width] for b in raw for k in range(len(b) - width + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if count[b[k : k + width]] > 1:
                gone[k : k + width] = b"\1" * width
        spans = sum(g and not p for g, p in zip(gone, b"\0" + bytes(gone), strict=False))
        out.append((len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return out


def earlier_windows(docs, width):
    """Documents (id, text): words, removed words, words left."""
    split = [(i, WORD.findall(t or "")) for i, t in docs]
    first = {}
    for i, words in split:
        for k in range(len(words) - width + 1):
            window = tuple(words[k : k + width])
            if i is not None:
                first[window] = min(i, first.get(window, i))
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - width + 1):
            if i is not None and first[tuple(words[k : k + width])] < i:
                gone.update(range(k, k + width))
        out.append((len(words), len(gone), " ".join(w for n, w in enumerate(words) if n not in gone)))
    return out


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]).encode(), 42) for k in range(n)]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def near_components(docs, bits=3):
    """Documents (id, text): print and least id in reach, by row."""
    prints = [fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                root[top(a)] = top(b)
    least = {}
    for n, (i, _) in enumerate(docs):
        if i is not None:
            least[top(n)] = min(i, least.get(top(n), i))
    return [(prints[n], least.get(top(n))) for n in range(len(docs))]


def targets(sizes, weights=(1, 2, 3), most=3):
    """Sources and sizes: target by resharing what is above, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in full]
        share = total - sum(full.values())
        whole = sum(weight[s] for s in left)
        got = {s: share * weight[s] / whole for s in left}
        above = {s for s in left if got[s] > most * sizes[s]}
        if not above:
            return full | got
        full |= {s: most * sizes[s] for s in above}


def audit(docs, least):
    """Rows (lang, source, text) of any number: the audit's rows, with 50 terms at most."""
    docs = [tuple(x or "" for x in row) for row in docs]
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    stands, counts = Counter(), Counter()
    for lang, source, text in docs:
        found = term.findall(text.translate(LOWER))
        stands.update({(lang, t) for t in found})
        counts.update((lang, source, t) for t in found)
    out = []
    for lang in {d[0] for d in docs}:
        terms = sorted(t for (x, t), n in stands.items() if x == lang and n >= least)
        sources = {s for x, s, _ in docs if x == lang}
        v = len(terms)

        def shares(count, terms=terms, v=v):
            n = sum(map(count, terms))
            return {t: 1 + 10**9 * (count(t) + 5) // (n + 5 * v) for t in terms}

        p = {s: shares(lambda t, s=s: counts[lang, s, t]) for s in sources}
        q = shares(lambda t: sum(counts[lang, s, t] for s in sources))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in terms), o) for o in sources if o != s]
            marks = [(p[s][t] - q[t], t) for t in terms if counts[lang, s, t] and p[s][t] > q[t]]
            for part, rows in (("pair", pairs), ("term", marks)):
                rows.sort(key=lambda r: (-r[0], r[1].encode()))
                for rank, (value, item) in enumerate(rows, 1):
                    if part == "pair" or rank <= 50:
                        out.append((lang, s, part, item, value, rank))
    return sorted(out)


def repaired(rows):
    """Rows (turn, role, text) of one conversation: counts, cost, audit and the repaired rows.

    Every edit of every row from every state, least cost first, then least audit.
    """
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        visible = "".join(WORD.findall(text))
        fault = "blank" if not visible else "duplicate" if (role, text) in seen else (
            "" if visible[-1] in ".!?" else "truncated"
        )
        seen.add((role, text))
        faults.append(fault)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    # What may stand before: "", "s", "u" or "a" as the last initial.
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}
    named = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}

    def add(into, last, cost, audit, made):
        if last not in into or (cost, audit) < into[last][:2]:
            into[last] = (cost, audit, made)

    def insertions(states):
        for _ in range(4):
            for last, (cost, audit, made) in list(states.items()):
                for x in legal[last]:
                    if x in named:
                        add(states, x, cost + 5, audit + "I", (*made, (named[x], "")))
        return states

    best = insertions(best)
    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for last, (cost, audit, made) in best.items():
            add(after, last, cost + 2, audit + "D", made)
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault else 0
            if role[:1] and role[:1] in legal[last]:
                add(after, role[:1], cost + more, audit + "K", (*made, (role, text)))
            for x in legal[last]:
                if x in named:
                    add(after, x, cost + 1 + more, audit + "R", (*made, (named[x], text)))
        best = insertions(after)
    cost, audit, made = min((best[x] for x in ("", "a") if x in best), key=lambda b: b[:2])
    count = Counter(faults)
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, list(made))


def reputations(pages, suffix_of):
    """Pages (host, bad or None): by host the posterior a, b of its bad rate."""
    known = [(suffix_of(h), h, bad) for h, bad in pages]
    levels = [lambda x: x[0][0], lambda x: x[0][1], lambda x: x[1]]

    def totals(level):
        n, y = Counter(), Counter()
        for row in known:
            n[level(row)] += row[2] is not None
            y[level(row)] += row[2] or 0
        return n, y

    def weight(groups):
        squares = sum((y - n * m) ** 2 for n, y, m in groups.values())
        plain = sum(n * m * (1 - m) for n, y, m in groups.values())
        pairs = sum(n * m * (1 - m) * (n - 1) for n, y, m in groups.values())
        r = min(max((squares - plain) / pairs if pairs else 0.05, 0.001), 0.9)
        return (1 - r) / r

    all_n, all_y = (sum(x.values()) for x in totals(levels[0]))
    n, y = totals(levels[0])
    groups = {k: (n[k], y[k], (0.5 + all_y - y[k]) / (1 + all_n - n[k])) for k in n}
    for parent, level in zip(levels, levels[1:], strict=False):
        w, above = weight(groups), groups
        of = {level(row): parent(row) for row in known}
        n, y = totals(level)
        groups = {}
        for k in n:
            pn, py, pm = above[of[k]]
            groups[k] = (n[k], y[k], (w * pm + py - y[k]) / (w + pn - n[k]))
    w = weight(groups)
    return {k: (w * m + y, w * (1 - m) + n - y) for k, (n, y, m) in groups.items()}
