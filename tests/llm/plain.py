"""Brute-force versions that the operators are held against."""

from __future__ import annotations

from collections import Counter

import numpy as np

BLANK = " \t\r\v\f"


class Sets:
    """Disjoint sets named by their smallest member."""

    def __init__(self, n: int):
        self.root = list(range(n))

    def find(self, x: int) -> int:
        while self.root[x] != x:
            x = self.root[x]
        return x

    def join(self, a: int, b: int) -> None:
        x, y = self.find(a), self.find(b)
        self.root[max(x, y)] = min(x, y)


def dedup_lines(texts: dict[int, str | None], size: int = 8, num: int = 80, den: int = 100) -> dict[int, str | None]:
    """Each text without its equal and similar lines but the first of their component."""
    first: dict[str, int] = {}
    for i in sorted(texts):
        for line in (texts[i] or "").split("\n"):
            if line.strip(BLANK):
                first.setdefault(line, len(first))
    lines = list(first)
    sets = [{x[k : k + size] for k in range(max(1, len(x) - size + 1))} for x in lines]
    index: dict[str, list[int]] = {}
    groups = Sets(len(lines))
    for k, s in enumerate(sets):
        for j, o in Counter(j for x in s for j in index.get(x, ())).items():
            if den * o >= num * (len(s) + len(sets[j]) - o):
                groups.join(k, j)
        for x in s:
            index.setdefault(x, []).append(k)
    seen, out = set(), {}
    for i in sorted(texts):
        kept = []
        for line in (texts[i] or "").split("\n"):
            if not line.strip(BLANK) or (groups.find(first[line]) == first[line] and line not in seen):
                kept.append(line)
                seen.add(line)
        out[i] = None if texts[i] is None else "\n".join(kept)
    return out


def edit_distance(pattern: bytes, text: bytes) -> int:
    """Least edit distance of the pattern to any part of the text."""
    p, t = np.frombuffer(pattern, np.uint8), np.frombuffer(text, np.uint8)
    row, at = np.zeros(len(t) + 1, np.int64), np.arange(len(t) + 1)
    for i, c in enumerate(p, 1):
        new = np.minimum(row + 1, np.concatenate([[i], row[:-1] + (t != c)]))
        new[0] = i
        row = np.minimum.accumulate(new - at) + at
    return int(row.min())
