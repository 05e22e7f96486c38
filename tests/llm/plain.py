"""Plain versions of the operators' rules, for comparison."""

import re
from collections import defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def simhash(text):
    found = words(ascii_lower(text or ""))
    runs = [" ".join(found[i : i + 4]) for i in range(len(found) - 3)] if len(found) >= 4 else [" ".join(found)] * bool(found)
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def groups(n, linked):
    """The smallest index that each of n reaches over ``linked(i)``, indices above i."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i in range(n):
        for j in linked(i):
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def near_groups(fps, distance=4):
    all_fps = np.array(fps, np.uint64)
    return groups(len(fps), lambda i: (i + 1 + np.flatnonzero(np.bitwise_count(all_fps[i + 1 :] ^ all_fps[i]) <= distance)).tolist())


def targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    """Targets of sources in order, by the rule of stopping and resharing."""
    total, weight = share * sum(sizes), [weights[i % len(weights)] for i in range(len(sizes))]
    full = [False] * len(sizes)
    while True:
        rest = sum(w for w, f in zip(weight, full) if not f)
        level = (total - sum(epochs * s for s, f in zip(sizes, full) if f)) / rest if rest else 0
        now = [f or epochs * s <= level * w for s, w, f in zip(sizes, weight, full)]
        if now == full:
            return [epochs * s if f else level * w for s, w, f in zip(sizes, weight, full)]
        full = now


def sentence_repeats(docs, sentences, span=3, least=10):
    """``{(id, text): text without repeated runs}`` for a set of (id, text), by the rule as stated."""
    seen, gone, parts = {}, defaultdict(set), {}
    for ident, text in sorted(docs):
        parts[ident, text] = own = sentences(text)
        for start in range(len(own)):
            stop = next((e for e in range(start + span, len(own) + 1) if sum(len(words(s)) for s in own[start:e]) >= least), None)
            if stop is None:
                break
            run = tuple(w for s in own[start:stop] for w in words(ascii_lower(s)))
            if run in seen:
                gone[ident, text] |= set(range(start, stop))
            else:
                seen[run] = ident
    return {key: "".join(s for i, s in enumerate(own) if i not in gone[key]) for key, own in parts.items()}
