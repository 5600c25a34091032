"""Ranked search against plain scores of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import mask_search as ms


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n, length = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = set()
    for item, wanted in asked.items():
        scores = []
        for doc, bag in bags:
            m = 50 + (50 * sum(bag.values()) * n) // length if bag else 0
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in wanted if t in bag
            )
            if score:
                scores.append((-score, doc is None, doc or 0, doc))
        scores.sort(key=lambda x: x[:3])
        out |= {(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(scores[:k], 1)}
    return out


WORDS = ["sand", "Tide", "kelp", "été", "9", "reef", "Gull", "东京", "wave", "salt", "dune", "a"]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(8)
    text = lambda n: " ".join(rng.choice(WORDS) + rng.choice(["", "", ".", "_x", "-"]) for _ in range(n))
    docs = [(i, text(rng.randrange(0, 30))) for i in range(300)]
    docs += [(7, docs[7][1]), (300, docs[9][1]), (-3, docs[9][1]), (None, docs[9][1]), (301, None), (302, ""), (303, "..."), (304, text(30_000))]
    items = [(k, text(rng.randrange(1, 8))) for k in range(12)] + [(50, " ".join(f"w{i}" for i in range(90)) + " sand kelp"), (51, None), (52, "nowhere"), (3, "dune"), (None, "Reef")]
    return docs, items


@pytest.mark.parametrize("k, sizes", [(50, {}), (5, {"most_docs": 17}), (1, {"block_terms": 9, "most_docs": 64}), (400, {})])
def test_ranks_are_those_of_all_scores(spark, make_docs, tables, k, sizes):
    docs, items = tables
    given = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rank int, score long")
    found = ms.ranked_search(make_docs(docs), given, k, **sizes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute(docs, items, k)


def test_empty_tables(spark, make_docs, tables):
    docs, items = tables
    given = spark.createDataFrame(items, "item_id long, text string")
    assert ms.ranked_search(make_docs([]), given).collect() == []
    assert ms.ranked_search(make_docs([(1, None), (2, "?")]), given).collect() == []
    assert ms.ranked_search(make_docs(docs), given.limit(0)).collect() == []


def test_masks_of_many_terms():
    rng = np.random.default_rng(1)
    present = rng.random((70, 40)) < 0.02
    masks, group = ms.masks_of(present)
    assert (masks[group] == present.T).all() and len({m.tobytes() for m in masks}) == len(masks)


def test_low_masks_are_not_scored(monkeypatch):
    """Once ``k`` good rows are kept, documents whose mask cannot reach them are never looked at."""
    scored = []
    monkeypatch.setattr(ms.Best, "add", lambda self, s, d, z, add=ms.Best.add: (scored.extend(d.tolist()), add(self, s, d, z))[1])
    weights, best = np.array([5000, 10]), [ms.Best(3)]
    n = 1000
    both = np.arange(n) % 100 == 0
    lengths = 1 + both.astype(int)
    flat = np.concatenate([[0, 1] if b else [1] for b in both])
    ms.search_slice(best, [np.array([0, 1])], weights, np.arange(n), np.zeros(n, bool), np.full(n, 100), lengths, flat, np.ones(len(flat), int))
    assert sorted(scored) == list(range(0, n, 100)) and best[0].doc.tolist() == [0, 100, 200]
