"""Mixing, decontamination and the removal of repeated passages."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontamination as dc
from tidemark.llm import mixing, substrings

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return BLANK.findall(text or "")


# ------------------------------------------------------------------ mixing


def brute_targets(sizes, weights=(5.0, 2.0, 1.0), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s] + 1e-9]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in over)
        free -= set(over)
    return out


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 300}, {"a": 1}, {"a": 0, "b": 9}, {f"s{i:02}": 3 * i * i for i in range(30)}])
def test_targets_are_those_of_the_rounds(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    assert all(got[s] == pytest.approx(want[s]) for s in want)
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_mix_keeps_rows_and_bounds(make_docs, odd_pairs):
    docs = make_docs(odd_pairs)
    first, again = (sorted(map(str, mixing.mix(docs).collect())) for _ in range(2))
    assert first == again
    mixed = mixing.mix(docs)
    assert set(docs.columns) < set(mixed.columns) | {"x"} and mixed.count() == len(odd_pairs)
    rows = mixed.collect()
    assert all(r.size == len(words(r.text)) and 0 <= r.copies <= 2 for r in rows)
    assert mixing.emit_copies(mixed).count() == sum(r.copies for r in rows)


def test_taken_words_come_near_the_target(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.sequence(F.lit(1), (F.col("id") % 9 + 1).cast("int"))).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
    )
    for r in mixing.mix(docs).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("target")).collect():
        assert r.taken == pytest.approx(r.target, rel=0.1)


def test_mix_of_nothing(make_docs):
    assert mixing.mix(make_docs([])).count() == 0


# ------------------------------------------------------------------ decontamination


def brute_hits(text, items, n=10):
    own = [x.lower() if x.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
    hit, found = set(), set()
    for item, passage in items:
        theirs = dc.normal_words(passage)
        size = min(n, len(theirs))
        grams = {tuple(theirs[i : i + size]) for i in range(len(theirs) - size + 1)} if theirs else set()
        for i in range(len(own) - size + 1):
            if tuple(own[i : i + size]) in grams:
                hit |= set(range(i, i + size))
                found.add(item)
    return len(own), len(hit), sorted(found)


def passage_docs():
    q = "Which of the, nine-small BIRDS eats seeds in the cold winter morning near Köln again?"
    return q, [
        (1, "Intro... " + q.upper().replace("KÖLN", "KöLN") + " outro"),
        (2, "which of the nine small birds eats seeds in the"),
        (3, "which of the nine small birds eats seeds in  the!! and more"),
        (4, "which of the nine small birds eats seeds in there"),
        (5, "tiny answer"),
        (6, None),
        (7, ""),
        (7, "TINY-answer, tiny answer"),
        (None, "a tiny answer"),
        (8, ("pad " * 3000) + q + (" pad" * 3000)),
    ]


@pytest.mark.parametrize("block_bytes", [dc.BLOCK_BYTES, 60])
def test_passages(spark, make_docs, block_bytes):
    q, pairs = passage_docs()
    items = [(1, q), (2, "tiny answer"), (2, "tiny answer"), (3, None), (4, "?!"), (None, "pad pad"), (5, q + " extra words here")]
    benchmark = spark.createDataFrame([(*x, "extra") for x in items], "item_id long, text string, doc_id string")
    got = dc.find_passages(make_docs(pairs), benchmark, block_bytes=block_bytes).collect()
    named = [x for x in items if x[0] is not None]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    want = sorted(((i, *brute_hits(t, named)) for i, t in pairs), key=key)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=key) == want
    texts = {i: t for i, t in pairs}
    (first,) = [r for r in got if r.doc_id == 1]
    assert [texts[1][a:b] for a, b in first.spans] == [texts[1][9:-7].rstrip("? ")]
    clean = dc.without_passages(make_docs(pairs), benchmark, block_bytes=block_bytes)
    assert sorted(clean.columns) == sorted(make_docs([]).columns)
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(r[0]) for r in want if not r[2])


def test_nothing_to_find(spark, make_docs, odd_pairs):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = make_docs(odd_pairs)
    assert dc.find_passages(docs, none).filter("n_hit > 0 OR size(items) > 0").count() == 0
    assert dc.without_passages(docs, none).count() == len(odd_pairs)
    assert dc.find_passages(make_docs([]), none).count() == 0


# ------------------------------------------------------------------ repeated passages


def brute_cut(pairs, n):
    seen = {}
    for i, t in pairs:
        own = words(t)
        for k in range(len(own) - n + 1):
            g = tuple(own[k : k + n])
            if i is not None:
                seen[g] = min(seen.get(g, i), i)
    out = []
    for i, t in pairs:
        own = words(t)
        gone = set()
        for k in range(len(own) - n + 1):
            if i is not None and seen[tuple(own[k : k + n])] < i:
                gone |= set(range(k, k + n))
        out.append((i, len(own), len(gone), " ".join(x for k, x in enumerate(own) if k not in gone)))
    return Counter(out)


@pytest.mark.parametrize("cells", [substrings.MAX_CELLS, substrings.MIN_CELLS])
def test_repeats(make_docs, odd_pairs, cells):
    more = [(20, None), (21, "q " * 40), (22, "q " * 30), (23, odd_pairs[0][1].upper() + " " + odd_pairs[9][1][500:3000]), (3, odd_pairs[3][1])]
    pairs = odd_pairs + more
    got = Counter(tuple(r) for r in substrings.remove_repeats(make_docs(pairs), max_cells=cells).collect())
    assert got == brute_cut(pairs, 13)


def test_full_sketch_loses_nothing(make_docs, odd_pairs, monkeypatch):
    """When every cell is taken, all windows pass to the exact grouping."""
    import numpy as np

    full = substrings.Sketch(substrings.MIN_CELLS, [np.full(substrings.MIN_CELLS // 8, 255, np.uint8)] * substrings.ROWS)
    monkeypatch.setattr(substrings, "sketch", lambda *_: full)
    got = Counter(tuple(r) for r in substrings.remove_repeats(make_docs(odd_pairs), window=3).collect())
    assert got == brute_cut(odd_pairs, 3)


def test_sketch_overestimates(make_docs, odd_pairs):
    """Every window that occurs twice is called repeated, and most others are not."""
    import numpy as np
    import pyarrow as pa

    from tidemark.llm.words import text_slices

    docs = make_docs(odd_pairs)
    known = substrings.sketch(docs, 4, substrings.MIN_CELLS)
    keys = np.concatenate([substrings.windows(d, o, 4)[0] for _, _, d, o in text_slices(pa.array([t for _, t in odd_pairs]))])
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    called = known.repeated(keys)
    assert called[counts[inverse] > 1].all()
    assert called[counts[inverse] == 1].mean() < 0.05


def test_no_repeats_in_nothing(make_docs):
    assert substrings.remove_repeats(make_docs([])).count() == 0


def test_equal_first_keys(spark):
    import numpy as np

    table = (np.array([5, 5, 9], np.uint64), np.array([1, 3, 1], np.uint32), np.array([10, 20, 30]))
    got = substrings._smallest(table, np.array([5, 5, 5, 9, 7, 99], np.uint64), np.array([3, 1, 2, 1, 1, 1], np.uint32))
    big = np.iinfo(np.int64).max
    assert got.tolist() == [20, 10, big, 30, big, big]
