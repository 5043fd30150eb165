"""Plain versions of the operators, for small inputs."""

import re
from collections import defaultdict

import numpy as np

NO_ID = 2**63 - 1


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


class Union:
    def __init__(self, n):
        self.parent = list(range(n))

    def find(self, x):
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def smallest(self, ids):
        groups = defaultdict(list)
        for i, value in enumerate(ids):
            if value is not None:
                groups[self.find(i)].append(value)
        return [min(groups[self.find(i)], default=None) for i in range(len(ids))]


def components(rows, size, percent):
    sets = []
    for _, text in rows:
        w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        long = [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]
        sets.append(set(long) if len(w) >= size else {tuple(w)} if w else set())
    union, holders = Union(len(rows)), defaultdict(list)
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for shingle in s:
            for j in holders[shingle]:
                shared[j] += 1
            holders[shingle].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                union.parent[union.find(i)] = union.find(j)
    least = union.smallest([d for d, _ in rows])
    return sorted(((d, len(s), c) for (d, _), s, c in zip(rows, sets, least)), key=str)


def without_repeats(rows, size=13):
    first, docs, out = {}, [], []
    for doc, text in rows:
        w, order = words(text), NO_ID if doc is None else doc
        docs.append((doc, order, w))
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            first[key] = min(first.get(key, NO_ID), order)
    for doc, order, w in docs:
        bad = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < order:
                bad.update(range(i, i + size))
        out.append((doc, len(w), len(bad), " ".join(x for i, x in enumerate(w) if i not in bad)))
    return sorted(out, key=str)


def vector_links(rows, threshold):
    def usable(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    vectors = [np.array(v, float) / max(map(abs, v)) if usable(v) else None for _, v in rows]
    union, links = Union(len(rows)), [0] * len(rows)
    for i, a in enumerate(vectors):
        for j, b in enumerate(vectors[:i]):
            if a is not None and b is not None and len(a) == len(b):
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    union.parent[union.find(i)] = union.find(j)
    least = union.smallest([d for d, _ in rows])
    return sorted(((d, n, c, d == c) for (d, _), n, c in zip(rows, links, least)), key=str)
