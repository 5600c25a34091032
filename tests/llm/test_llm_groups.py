"""Near-duplicate join, connected components and fingerprints."""

import hashlib
import random
import re
import zlib

import pytest
import regex
import xxhash
from tests_llm_brute import brute_near, prose
from tidemark.llm import fingerprints as fp
from tidemark.llm import jaccard_join as jj
from tidemark.llm.components import connected


def variants(base, n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = rng.choice(["one", "two", "three"])
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [jj.BLOCK_SHINGLES, 200])
def test_near_duplicates(make_docs, odd_pairs, block):
    base = odd_pairs[9][1][:600]
    pairs = [p for p in odd_pairs if p[0] is not None]
    pairs += [(100 + i, t) for i, t in enumerate(variants(base, 40, 1))] + [(200, "a b c"), (201, "a  b\nc"), (202, "a b d"), (203, "a b c d e f")]
    got = {r.doc_id: (r.class_id, r.links, r.copy_of) for r in jj.near_duplicates(make_docs(pairs + [(None, base)]), block_shingles=block).collect()}
    assert got == brute_near(dict(pairs))


def test_blocks_bound_texts_and_shingles(spark, make_docs):
    texts = [(1, 12)] * 9000 + [(2, 800_001)] * 2 + [(3, 5)]
    rows = spark.createDataFrame(texts, "component long, n_shingles long")
    assert {r.component: r.blocks for r in jj.block_counts(rows).collect()} == {1: 5, 2: 5, 3: 1}
    pairs = [(i, t) for i, t in enumerate(variants("a b c d e f g h i j k l m n o p q r s t", 30, 2))]
    got = {r.doc_id: (r.class_id, r.links, r.copy_of) for r in jj.near_duplicates(make_docs(pairs), block_texts=3).collect()}
    assert got == brute_near(dict(pairs))


def test_several_texts_under_one_id(make_docs):
    texts = ["a b c d e f g h", "i j k l m n o p"]
    rows = jj.near_duplicates(make_docs([(1, texts[0]), (1, texts[1]), (2, texts[0]), (3, texts[1]), (4, None)])).collect()
    got = {r.doc_id: (r.class_id, r.links) for r in rows}
    assert len(rows) == 4 and got[4] == (4, 0) and got[1] == (1, 1)
    assert sorted([got[2], got[3]]) in ([(1, 1), (3, 0)], [(1, 1), (2, 0)])


def test_no_documents(make_docs):
    assert jj.near_duplicates(make_docs([])).count() == 0
    assert jj.near_duplicates(make_docs([(1, None), (2, "")])).count() == 2


def test_depth_is_the_longest_that_meets_the_recall():
    assert jj.prefix_length() == 5
    assert jj.prefix_length(recall=0.9) > jj.prefix_length(recall=0.999999)
    assert 1 - (1 - 0.8**5) ** jj.TREES > jj.RECALL > 1 - (1 - 0.8**6) ** jj.TREES


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1100)] + [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    want = {x: find(x) for x in parent if sum(x in e and e[0] != e[1] for e in edges)}
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges + [(1, None)], "a long, b long")).collect()}
    assert got == want
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ fingerprints


def edited(texts):
    out = []
    for i, t in enumerate(texts):
        k = len(t) // 4
        out.append(t[: len(t) - k] + texts[(i + 1) % len(texts)][:k])
    return out


@pytest.mark.parametrize("rows", [1, 3, 2048])
def test_edited_texts(make_docs, odd_pairs, rows):
    order = sorted(odd_pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1] or ""))
    texts = [t or "" for _, t in order]
    want = sorted(str((i, len(t), hashlib.sha256(e.encode()).hexdigest())) for (i, _), t, e in zip(order, texts, edited(texts)))
    got = fp.digest(fp.compare_with_edited(make_docs(odd_pairs), rows)).collect()
    assert sorted(str((r.doc_id, r.n_chars, r.edited_sha256)) for r in got) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by_text = {}
    for r in got:
        if r.doc_id is not None:
            by_text.setdefault(dict(odd_pairs)[r.doc_id] or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert {r.near_edited for r in got if r.n_chars == 0} == {1.0}


def plain_signatures(text):
    """The set of a text again, in plain Python."""
    low = re.sub(r"\n+", f" {fp.LINE} ", text.lower())
    words = [w for w in regex.split(rf"[^\p{{L}}\p{{N}}{fp.LINE}]+", f" {fp.LINE} {low}") if w]
    anchors, out = {*fp.ANCHORS, fp.LINE}, set()
    for i, w in enumerate(words):
        if w in anchors or zlib.crc32(w.encode()) % fp.SPREAD == 0:
            chain = [x for x in words[i + 1 : i + 1 + fp.REACH] if x not in anchors][: 1 if w == fp.LINE else fp.CHAIN]
            if chain:
                out.add(xxhash.xxh64_intdigest(" ".join(chain).encode(), xxhash.xxh64_intdigest(w.encode(), 42)) >> 32)
    return out or {xxhash.xxh64_intdigest(text.encode(), xxhash.xxh64_intdigest(b"whole text", 42)) >> 32}


def test_fingerprints_and_likeness_as_in_plain_python(make_docs):
    texts = [prose(70 + i, 12 * i) for i in range(12)] + ["the", "and", "the", "", "?!", "Der Hund\n\nund die Katze\nläuft 3x", "el río", "the and is"]
    rows = {r.doc_id: r for r in fp.digest(fp.compare_with_edited(make_docs(list(enumerate(texts))))).collect()}
    alike = lambda a, b: len(a & b) / len(a | b)
    for i, (text, changed) in enumerate(zip(texts, edited(texts))):
        own, other, after = plain_signatures(text), plain_signatures(changed), plain_signatures(texts[(i + 1) % len(texts)])
        printed = [{int(x[k : k + 8], 16) for k in range(0, len(x), 8)} for x in (rows[i].fingerprint, rows[i].edited_fingerprint)]
        assert printed == [own, other]
        assert rows[i].near_edited == pytest.approx(alike(own, other)) and rows[i].near_next == pytest.approx(alike(own, after))
    assert rows[12].near_next == 0 and rows[12].fingerprint == rows[14].fingerprint


def test_likeness_follows_the_edit(make_docs):
    pairs = [(i, prose(50 + i, 300)) for i in range(20)]
    for r in fp.digest(fp.compare_with_edited(make_docs(pairs))).collect():
        assert 0.4 < r.near_edited < 0.8 and r.near_next < 0.1 and r.near_edited > r.near_next + 0.3


def test_no_fingerprints(make_docs):
    assert fp.compare_with_edited(make_docs([])).count() == 0


def test_place_counts_cuts(spark):
    cuts = sorted(random.Random(1).sample(range(10_000), 700))
    df = spark.range(-5, 10_005, 7)
    for r in df.select("id", fp.place(df.id, cuts).alias("n")).collect():
        assert r.n == sum(c <= r.id for c in cuts)
    assert {r[0] for r in df.select(fp.place(df.id, [])).collect()} == {0}


def test_similar_to_queries(make_docs, odd_pairs):
    docs = make_docs(odd_pairs)
    got = {(r.query_id, r.doc_id): r.similarity for r in fp.similar_to(docs.filter("doc_id in (3, 11)"), docs, 0.5).collect()}
    signs = {r.doc_id: set(r.s) for r in docs.filter("doc_id IS NOT NULL").select("doc_id", fp.signatures(docs.text).alias("s")).collect()}
    want = {}
    for a in (3, 11):
        for b in signs:
            if a != b and signs[b] and len(signs[a] & signs[b]) / len(signs[a] | signs[b]) >= 0.5:
                want[a, b] = len(signs[a] & signs[b]) / len(signs[a] | signs[b])
    assert got == pytest.approx(want) and len(got) >= 2
