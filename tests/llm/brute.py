"""Plain versions of the operators, for comparison."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Union:
    def __init__(self, items):
        self.parent = {x: x for x in items}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def shingles(text: str | None) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_components(docs: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    sets = {i: shingles(t) for i, t in docs.items()}
    u = Union(docs)
    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                u.join(a, b)
    return {i: (len(sets[i]), u.find(i)) for i in docs}


def removed_repeats(docs: dict[int, str | None], width: int = 200) -> dict[int, tuple[int, int, int, str]]:
    texts = {i: (t or "").encode() for i, t in docs.items()}
    seen = Counter(b[k : k + width] for b in texts.values() for k in range(len(b) - width + 1))
    out = {}
    for i, b in texts.items():
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if seen[b[k : k + width]] > 1:
                gone[k : k + width] = b"\x01" * width
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out
