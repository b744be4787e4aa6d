"""Slow and simple versions of the operators, to compare with."""

import hashlib
import re
from collections import defaultdict

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALPHANUMERIC = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha256(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def shingles(text, size=5):
    words = SPACED.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def linked(a, b, percent=80):
    return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)


def groups(docs, percent=80):
    """docs: list of (id, text); gives (id, number of shingles, component) for each."""
    sets = [shingles(text) for _, text in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if linked(sets[i], sets[j], percent):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            ids[root(i)].append(doc)
    return [
        (doc, len(sets[i]), min(ids[root(i)], default=None) if sets[i] else doc) for i, (doc, _) in enumerate(docs)
    ]


def removed(docs, window=50):
    """(id, words, removed, kept) for each of (id, text)."""
    words = [SPACED.findall(text or "") for _, text in docs]
    lowest = {}
    for (doc, _), own in zip(docs, words):
        if doc is not None:
            for i in range(len(own) - window + 1):
                key = tuple(own[i : i + window])
                lowest[key] = min(doc, lowest.get(key, doc))
    out = []
    for (doc, _), own in zip(docs, words):
        gone = set()
        if doc is not None:
            for i in range(len(own) - window + 1):
                if lowest[tuple(own[i : i + window])] < doc:
                    gone.update(range(i, i + window))
        out.append((doc, len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone)))
    return out


def hits(text, items, window=10):
    """(words, hit words, sorted ids of items as text)."""
    words = ALPHANUMERIC.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, item_text in items:
        own = ALPHANUMERIC.findall((item_text or "").translate(LOWER))
        size = min(window, len(own))
        wanted = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in wanted:
                hit.update(range(i, i + size))
                if item is not None:
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def without_shared_lines(docs, min_sites=8):
    """(text, lines, removed) for each of (text, site)."""
    sites = defaultdict(set)
    for text, site in docs:
        for line in (text or "").split("\n"):
            if line.strip(" ") and site is not None:
                sites[line.strip(" ")].add(site)
    out = []
    for text, _ in docs:
        if text is None:
            out.append((None, 0, 0))
            continue
        lines = text.split("\n")
        kept = [x for x in lines if len(sites.get(x.strip(" "), ())) < min_sites]
        left = "\n".join(kept)
        if not any(x.strip(" ") for x in kept):
            kept, left = lines, text
        out.append((left if len(kept) < len(lines) else text, len(lines), len(lines) - len(kept)))
    return out
