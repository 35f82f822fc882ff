"""Plain single-machine versions of what the operators compute."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text):
    return (text or "").translate(UPPER)


def smallest_reachable(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def near_classes(docs, size, percent=80):
    """{doc_id: (n_shingles, component)} by comparing all pairs."""
    sets = {}
    for i, text in docs.items():
        w = WORD.findall(lower(text))
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    pairs = {(a, b) for members in holders.values() for a in members for b in members if a < b}
    links = [p for p in pairs if 100 * len(sets[p[0]] & sets[p[1]]) >= percent * len(sets[p[0]] | sets[p[1]])]
    found = smallest_reachable(docs, links)
    return {i: (len(sets[i]), found[i]) for i in docs}


def without_repeats(docs, window=50):
    """{doc_id: (n_words, n_removed, kept)} by listing every window."""
    words = {i: WORD.findall(t or "") for i, t in docs.items()}
    first = {}
    for i in sorted(docs):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][k : k + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), kept)
    return out


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()
