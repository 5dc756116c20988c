"""Plain versions of the corpus operators, for small tables."""

import collections
import hashlib


def repeats_of_words(rows, length=50):
    """{id: (words, removed, sha of what is left)}; the smallest id keeps a window."""
    out, seen = {}, {}
    for id_, text in sorted(rows):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - length + 1):
            if seen.setdefault(tuple(words[s : s + length]), id_) < id_:
                gone[s : s + length] = [True] * length
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[id_] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def repeats_of_bytes(rows, length=400):
    data = [(i, (t or "").encode()) for i, t in rows]
    counts = collections.Counter(b[s : s + length] for _, b in data for s in range(len(b) - length + 1))
    out = {}
    for id_, b in data:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if counts[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[id_] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def shingle_set(text, n):
    words = (text or "").encode().lower().split()
    if len(words) < n:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}


def alike(rows, n, percent):
    """{id: (shingles, least id reachable)}."""
    sets = {i: shingle_set(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = collections.defaultdict(list)
    for i, s in sets.items():
        common = collections.Counter(j for g in s for j in lists[g])
        for j, both in common.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for g in s:
            lists[g].append(i)
    return {i: (len(s), root(i)) for i, s in sets.items()}
