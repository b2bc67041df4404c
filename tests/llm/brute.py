"""Plain Python twins of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

NO_ID = 2**63 - 1
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def repeated(rows, tokens, window):
    """(id, tokens, removed) of each row; rows are (id, text)."""
    first = {}
    split = [(NO_ID if i is None else i, tokens(t or "")) for i, t in rows]
    for i, ts in split:
        for p in range(len(ts) - window + 1):
            w = tuple(ts[p : p + window])
            first[w] = min(first.get(w, i), i)
    out = []
    for i, ts in split:
        gone = [False] * len(ts)
        for p in range(len(ts) - window + 1):
            if first[tuple(ts[p : p + window])] < i:
                gone[p : p + window] = [True] * window
        out.append((i, ts, gone))
    return out


def bytes_removed(rows):
    for (i, _), (_, ts, gone) in zip(rows, repeated(rows, lambda t: t.encode(), 50), strict=True):
        kept = bytes(b for b, g in zip(ts, gone, strict=True) if not g)
        spans = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        yield i, len(ts), sum(gone), spans, sha(kept)


def words_removed(rows):
    for (i, _), (_, ts, gone) in zip(rows, repeated(rows, WORD.findall, 13), strict=True):
        kept = [w for w, g in zip(ts, gone, strict=True) if not g]
        yield i, len(ts), sum(gone), sha(" ".join(kept).encode())


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def smallest(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_groups(rows, percent=85):
    """(id, set size, smallest id of the component, kept) of each row."""
    sets = [shingles(t) for _, t in rows]
    ids = [NO_ID if i is None else i for i, _ in rows]
    index = defaultdict(list)
    for n, s in enumerate(sets):
        for x in s:
            index[x].append(n)
    common = defaultdict(int)
    for rows_of in index.values():
        for a in rows_of:
            for b in rows_of:
                if a < b:
                    common[a, b] += 1
    links = [
        (a, b) for (a, b), c in common.items() if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c)
    ]
    group = smallest(range(len(rows)), links)
    least = defaultdict(lambda: NO_ID)
    for n, i in enumerate(ids):
        least[group[n]] = min(least[group[n]], i)
    none = lambda x: None if x == NO_ID else x
    return [
        (none(i), len(sets[n]), none(least[group[n]]), i == least[group[n]]) for n, i in enumerate(ids)
    ]
