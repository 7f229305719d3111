"""Plain versions of the operators for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def substring_rows(docs: list[tuple[int, str | None]], window: int) -> dict[int, tuple]:
    """doc_id -> (n_words, n_removed, kept_sha256); doc_ids are unique."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        w = words(text)
        keep = [True] * len(w)
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            if key in seen:
                keep[p : p + window] = [False] * window
            seen.add(key)
        kept = [x for x, k in zip(w, keep) if k]
        out[doc] = (len(w), len(w) - len(kept), sha(" ".join(kept)))
    return out


def shingles(text: str | None, size: int = 5) -> frozenset:
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def near_rows(docs: list[tuple[int, str | None]], percent: int = 75) -> dict[int, tuple]:
    """doc_id -> (n_shingles, component_id, kept)."""
    sets = {doc: shingles(text) for doc, text in docs}
    holders = defaultdict(set)
    for doc, s in sets.items():
        for g in s:
            holders[g].add(doc)
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, s in sets.items():
        for b in set().union(*(holders[g] for g in s)) if s else ():
            both = len(s & sets[b])
            if a < b and 100 * both >= percent * (len(s) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {doc: (len(s), find(doc), find(doc) == doc) for doc, s in sets.items()}


def exact_rows(docs: list[tuple[int, str | None]]) -> dict[int, tuple]:
    """doc_id -> (keep_id, group_size, kept, text_sha256)."""
    groups = defaultdict(list)
    for doc, text in docs:
        groups[(text or "").translate(LOWER)].append(doc)
    return {doc: (max(g), len(g), doc == max(g), sha(text)) for text, g in groups.items() for doc in g}
