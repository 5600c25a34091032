"""Plain versions that the tests compare with."""

import random
from itertools import combinations

WORDS = "stone river the of window paper and light green house a bird moves over cold water slowly while people watch".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "s", "ing"]) for _ in range(n))


def shingles(text, n=5):
    w = (text or "").split()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute_near(texts, threshold=0.8):
    """doc_id -> (class_id, links, copy_of)."""
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in sets}
    links = dict.fromkeys(sets, 0)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and common >= threshold * len(sets[a] | sets[b]) - 1e-9:
            links[a] += 1
            links[b] += 1
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    copy = {i: min([i] + [j for j in sets if sets[i] and sets[j] == sets[i]]) for i in sets}
    return {i: (find(i), links[i], copy[i]) for i in sets}
