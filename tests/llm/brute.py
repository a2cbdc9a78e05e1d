"""Plain Python versions of the deduplicating operators."""

import re
from collections import Counter, defaultdict

WS = r"[^\x20\x09-\x0D]+"


def ascii_lower(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t)


def components(rows, percent=85, n=5):
    """{id: (number of shingles, smallest id reachable)} of (id, text) rows."""
    sets = {}
    for i, t in rows:
        w = re.findall(WS, ascii_lower(t or ""))
        sets[i] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    having = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            having[x].append(i)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in sets.items():
        for j, both in Counter(j for x in s for j in having[x] if j < i).items():
            if find(i) != find(j) and 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def repeats(rows, window=50):
    """{id: (words, which are removed)} of (id, text) rows."""
    first, words = {}, {}
    for i, t in rows:
        w = words[i] = re.findall(WS, t or "")
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            first[g] = min(first.get(g, i), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out[i] = (w, gone)
    return out
