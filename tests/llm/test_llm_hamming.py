"""Near-duplicate components against all pairs, and the guarantee of the index."""

import random
from itertools import combinations

import numpy as np
import pytest
from tests_llm_brute import prose

from tidemark.llm import hamming_join as hj


def word_set(text, n=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)])


def brute(pairs, percent=85):
    """doc_id -> (n_shingles, component_id) with the texts of one doc_id as one document."""
    sets = {}
    for i, text in pairs:
        if i is not None:
            sets.setdefault(i, []).append(word_set(text))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (max(len(s) for s in sets[i]), find(i)) for i in sets}


def edited(text, rng, share):
    return " ".join(rng.choice(["flint", "moss", "ember"]) if rng.random() < share else w for w in text.split())


@pytest.fixture(scope="module")
def copies():
    """Families of copies at similarities around the threshold, in chains, and texts that share only a template."""
    rng, pairs = random.Random(5), []
    for family in range(12):
        text = prose(100 + family, rng.choice([4, 20, 60, 150]))
        for _ in range(rng.randrange(1, 9)):
            pairs.append((len(pairs), text))
            text = edited(text, rng, rng.choice([0.0, 0.01, 0.02, 0.03, 0.05]))
    template = prose(999, 30)
    pairs += [(1000 + k, f"{template} {prose(2000 + k, 20)}") for k in range(40)]
    rng.shuffle(pairs)
    return pairs


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("blocks", [{}, {"block_signatures": 3, "block_classes": 2, "block_shingles": 100}])
def test_components_are_those_of_all_pairs(make_docs, copies, blocks):
    assert result(hj.near_components(make_docs(copies), **blocks)) == brute(copies)


def test_odd_rows(make_docs, odd_pairs):
    pairs = [*odd_pairs, (3, prose(77, 40)), (20, prose(77, 40).upper())]
    rows = hj.near_components(make_docs(pairs)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None} == brute(pairs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows if r.doc_id is not None)
    nameless = sorted((r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is None)
    assert nameless == sorted((len(word_set(t)), None, None) for i, t in pairs if i is None)


def test_empty_table(make_docs):
    assert hj.near_components(make_docs([])).collect() == []


def test_near_signatures_share_a_key():
    rng = np.random.default_rng(3)
    for _ in range(300):
        one = rng.integers(0, 256, hj.POSITIONS, np.uint8)
        other = one.copy()
        wrong = rng.choice(hj.POSITIONS, hj.REACH, replace=False)
        other[wrong] ^= rng.integers(1, 256, hj.REACH).astype(np.uint8)
        words = np.stack([one, other]).view("<u8")
        keys = hj.index_keys(words)
        assert set(keys[0]) & set(keys[1])
        assert hj.distances(words, words[0]).tolist() == [0, hj.REACH]


def test_distance_in_columns_is_the_same(spark):
    rng = np.random.default_rng(4)
    values = rng.integers(0, 3, (20, hj.POSITIONS)).astype(np.uint8).view("<i8")
    df = spark.createDataFrame([(i, *map(int, row)) for i, row in enumerate(values)], "id long, " + ", ".join(f"{w} long" for w in hj.WORDS64))
    rows = df.alias("l").join(df.alias("r"), on=hj.F.expr("l.id < r.id")).select("l.id", "r.id", hj.distance("l", "r")).collect()
    words = values.view(np.uint64)
    assert rows and all(d == hj.distances(words[b : b + 1], words[a])[0] for a, b, d in rows)
