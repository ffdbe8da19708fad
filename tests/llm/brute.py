"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None):
    """A documents table; sources and languages go round."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", f"src{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, DOCUMENT)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def small_letters(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, n):
    found = words(small_letters(text))
    if not found:
        return frozenset()
    k = min(n, len(found))
    return frozenset(tuple(found[i : i + k]) for i in range(len(found) - k + 1))


def classes(n, linked):
    """Class of each of n rows under links given by a predicate on rows."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(n)]


def similar(texts, ids, n, up, down):
    """(id, set size, smallest id reachable) of each row."""
    sets = [shingles(t, n) for t in texts]

    def linked(i, j):
        both = len(sets[i] & sets[j])
        return bool(sets[i]) and bool(sets[j]) and down * both >= up * (len(sets[i]) + len(sets[j]) - both)

    groups = defaultdict(list)
    of = classes(len(texts), linked)
    for i, c in enumerate(of):
        groups[c].append(ids[i])
    least = {c: min((x for x in g if x is not None), default=None) for c, g in groups.items()}
    return [(ids[i], len(sets[i]), least[of[i]] if sets[i] else ids[i]) for i in range(len(texts))]


def without_windows(texts, ids, window):
    """Words left of each text, in order."""
    found = [words(t) for t in texts]
    first = {}
    for i, w in zip(ids, found, strict=True):
        for p in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[p : p + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, w in zip(ids, found, strict=True):
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        out.append([x for k, x in enumerate(w) if k not in gone])
    return out
