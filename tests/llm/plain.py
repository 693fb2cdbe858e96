"""Plain versions of joins, for comparison on small tables."""

import collections


def shingle_set(text, width=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    k = min(width, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def linked(docs):
    """doc_id -> smallest doc_id reachable by links of 75 percent, by comparing what shares words."""
    sets = {i: shingle_set(t) for i, t in docs}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in sets.items():
        shared = collections.Counter(j for x in s for j in holders[x] if j < i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}
