"""Plain Python versions that the operators are held against."""

from __future__ import annotations

import itertools


def shingles(text: str | None, width: int = 5) -> set[tuple]:
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def similar(a: set, b: set, percent: int = 75) -> bool:
    shared = len(a & b)
    return bool(a and b) and 100 * shared >= percent * (len(a) + len(b) - shared)


def components(sets: dict, percent: int = 75) -> dict:
    """Smallest key reachable over links, by trying all pairs."""
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if similar(sets[a], sets[b], percent):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}
