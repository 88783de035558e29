"""Plain versions of the operators for small tables; rows are (doc_id, text)."""

from __future__ import annotations

import re


def shingle_set(text: str | None) -> set:
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_duplicates(rows) -> dict:
    """doc_id: (n_shingles, component_id, kept)."""
    sets = {i: shingle_set(t) for i, t in rows}
    by_shingle: dict = {}
    for i, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    common: dict = {}
    for ids in by_shingle.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                common[a, b] = common.get((a, b), 0) + 1
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def repeated_bytes(rows, size: int = 400) -> dict:
    """doc_id: (bytes, removed runs as [begin, end), kept bytes)."""
    texts = {i: (t or "").encode() for i, t in rows}
    seen: dict = {}
    for i, t in texts.items():
        for p in range(len(t) - size + 1):
            seen.setdefault(t[p : p + size], []).append((i, p))
    covered = {i: bytearray(len(t)) for i, t in texts.items()}
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                covered[i][p : p + size] = b"\1" * size
    out = {}
    for i, t in texts.items():
        runs = [m.span() for m in re.finditer(b"\1+", bytes(covered[i]))]
        out[i] = (len(t), runs, bytes(c for c, gone in zip(t, covered[i]) if not gone))
    return out
