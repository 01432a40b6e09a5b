"""Plain single-machine versions of the operators, to hold their results against."""

from __future__ import annotations

import collections
import hashlib
import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall(t or "")


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def component_ids(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def simhash(t, size=3):
    w = words((t or "").translate(UPPER))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def simhash_groups(rows, bits=3):
    """{id: (fingerprint hex, component id)} for (id, text) rows with distinct ids."""
    fp = [simhash(t) for _, t in rows]
    a = np.array(fp, np.uint64)
    pairs = [(i, j) for i in range(len(fp)) for j in np.flatnonzero(np.bitwise_count(a[i] ^ a) <= bits).tolist() if j < i]
    comp = component_ids(len(rows), pairs)
    least = {}
    for (k, _), c in zip(rows, comp):
        least[c] = min(k, least.get(c, k))
    return {k: (f"{f:016x}", least[c]) for (k, _), f, c in zip(rows, fp, comp)}


def line_dedup(rows, min_docs=10):
    """[(id, n_lines, n_dropped, kept text)] in input order."""
    def key(x):
        return x.strip(" \t\n\x0b\f\r").translate(UPPER)
    seen = collections.Counter()
    for _, t in rows:
        seen.update({key(x) for x in (t or "").split("\n")})
    out = []
    for k, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or seen[key(x)] < min_docs]
        out.append((k, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def repeated_windows(rows, size=35):
    """[(id, n_words, n_removed, kept text)]: words in windows whose words start anywhere else, too."""
    seen = collections.Counter()
    for _, t in rows:
        w = words(t)
        seen.update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for k, t in rows:
        w = words(t)
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i:i + size])] > 1:
                gone.update(range(i, i + size))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((k, len(w), len(gone), " ".join(kept)))
    return out


def targets(sizes, weights=(5, 2, 1), share=1.5, passes=2):
    """{source: target}: held at ``passes`` x size, the excess reshared until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    held, total = {}, share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in held]
        rest, all_w = total - sum(held.values()), sum(w[s] for s in free)
        out = held | {s: rest * w[s] / all_w for s in free}
        over = [s for s in free if out[s] > passes * sizes[s]]
        if not over:
            return out
        held |= {s: passes * sizes[s] for s in over}
