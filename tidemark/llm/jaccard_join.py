"""Near-duplicate documents: MinHash banding for candidates, exact Jaccard similarity of word shingles for links.

A signature is split into trees; documents with an equal prefix of one tree's part of the signature meet. This replaces
the LSH forest: all prefixes have one depth, the longest with which a pair at the threshold meets in some tree with the
target recall, from a formula and not from the data. Documents with equal sets of shingles are one class, which is looked at once.

Documents that share a prefix are put into a component through the smallest of each bucket, never pair by pair.
Within a component all pairs are compared exactly, in blocks of bounded size, and a block gives one row for each
document: its number of links and the smallest document it hangs together with.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ready, written
from tidemark.llm.components import connected
from tidemark.llm.words import mix, sequence_hashes, text_slices, word_bounds, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
TREES = 24
LONGEST = 8
RECALL = 0.9995
#: Shingles of one side of a block that is compared in memory.
BLOCK_SHINGLES = 400_000
#: Texts of one side of such a block: the matrices of a pair of sides have as many rows and columns at most, about.
BLOCK_TEXTS = 2000
#: Shingles of one step of the matrix product.
STEP = 4096


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, longest: int = LONGEST, recall: float = RECALL) -> int:
    """The longest prefix with which a pair at the threshold meets in some tree with probability ``recall``."""
    for length in range(longest, 1, -1):
        if 1 - (1 - threshold**length) ** trees >= recall:
            return length
    return 1


# ------------------------------------------------------------------ sets of shingles


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle) of the distinct shingles of each text, in that order.

    A text of fewer than ``n`` words, but not none, has one shingle: all its words.
    """
    starts, ends, doc = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)
    count = np.bincount(doc, minlength=len(offsets) - 1)
    keys, owners = [], []
    for k in range(1, n + 1):
        runs = sequence_hashes(hashes, k)
        own = doc[: len(runs)]
        whole = own == doc[k - 1 : k - 1 + len(runs)]
        use = whole & (count[own] == k) if k < n else whole
        keys.append(runs[use])
        owners.append(own[use])
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    return owner[first], key[first]


def _edges(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place, text number) of each text that has shingles."""
    own, first = np.unique(owner, return_index=True)
    return first, own


def set_hashes(owner: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set that do not depend on order."""
    first, _ = _edges(owner)
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    one = np.add.reduceat(mix(key ^ np.uint64(0x5851F42D4C957F2D)), first)
    two = np.add.reduceat(mix(key + np.uint64(0x14057B7EF767814F)), first)
    return one.view(np.int64), two.view(np.int64)


def tree_keys(owner: np.ndarray, key: np.ndarray, trees: int, length: int) -> np.ndarray:
    """Per text with shingles, a hash of the prefix of its signature in each tree."""
    first, own = _edges(owner)
    seeds = mix(np.arange(1, trees * length + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.zeros((len(own), trees), np.uint64)
    for t in range(trees):
        for d in range(length):
            h = (key ^ seeds[t * length + d]) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
            out[:, t] = mix(out[:, t] * np.uint64(31) + np.minimum.reduceat(h, first)) if len(first) else 0
    return out.view(np.int64)


SIGNED = "doc_id long, h1 long, h2 long, n_shingles long, keys array<long>"


def sign_batches(batches: Iterator[pa.RecordBatch], n: int, trees: int, length: int) -> Iterator[pa.RecordBatch]:
    """Rows of SIGNED for the texts that have a word."""
    for batch in batches:
        ids = batch.column(0)
        for a, _, data, offsets in text_slices(batch.column(1)):
            owner, key = shingle_sets(data, offsets, n)
            first, own = _edges(owner)
            if not len(own):
                continue
            h1, h2 = set_hashes(owner, key)
            keys = tree_keys(owner, key, trees, length)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * trees, pa.int32()), pa.array(keys.ravel()))
            size = np.diff(np.append(first, len(owner)))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(own + a)), pa.array(h1), pa.array(h2), pa.array(size), flat], names=["doc_id", "h1", "h2", "n_shingles", "keys"]
            )


# ------------------------------------------------------------------ exact comparison of a block


def common_counts(owner: np.ndarray, key: np.ndarray, n_texts: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of common shingles of each text of ``left`` with each of ``right`` (text numbers)."""
    _, code, df = np.unique(key, return_inverse=True, return_counts=True)
    shared = df[code] > 1
    owner, code = owner[shared], code[shared]
    used, code = np.unique(code, return_inverse=True)
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    cuts = np.searchsorted(code, np.arange(0, len(used) + STEP, STEP))
    out = np.zeros((len(left), len(right)), np.float32)
    for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        part = np.zeros((n_texts, min(STEP, len(used) - k * STEP)), np.float32)
        part[owner[i:j], code[i:j] - k * STEP] = 1
        out += part[left] @ part[right].T
    return out


def components_of(linked: np.ndarray, left: np.ndarray, right: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The smallest name that each text is linked with, over any number of links."""
    root = names.copy()
    big = np.iinfo(np.int64).max
    while True:
        new = root.copy()
        np.minimum.at(new, left, np.where(linked, root[right][None, :], big).min(axis=1, initial=big))
        np.minimum.at(new, right, np.where(linked, root[left][:, None], big).min(axis=0, initial=big))
        if (new == root).all():
            return root
        root = new


def compare_block(texts: list[str], names: np.ndarray, copies: np.ndarray, sides: np.ndarray, same: bool, n: int, threshold: float):
    """(names, links, roots) of the texts of a block that have links. ``sides`` is False for the first block, True for the second."""
    owners, keys = [], []
    for a, _, data, offsets in text_slices(pa.array(texts, pa.large_string())):
        owner, key = shingle_sets(data, offsets, n)
        owners.append(owner + a)
        keys.append(key)
    owner, key = np.concatenate(owners), np.concatenate(keys)
    sizes = np.bincount(owner, minlength=len(texts)).astype(np.float64)
    left = np.flatnonzero(~sides)
    right = left if same else np.flatnonzero(sides)
    if not len(left) or not len(right):
        return names[:0], copies[:0], names[:0]
    common = common_counts(owner, key, len(texts), left, right).astype(np.float64)
    union = sizes[left][:, None] + sizes[right][None, :] - common
    linked = (common > 0) & (common >= threshold * union - 1e-9)
    if same:
        np.fill_diagonal(linked, False)
    links = np.zeros(len(texts), np.int64)
    links[left] += linked @ copies[right]
    if not same:
        links[right] += linked.T @ copies[left]
    some = np.flatnonzero(links)
    return names[some], links[some], components_of(linked, left, right, names)[some]


def compare_batches(batches: Iterator[pa.RecordBatch], n: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, links, root) from rows (component, i, j, side, doc_id, copies, h1, h2, text) sorted by block."""
    now, held = None, []

    def done() -> pa.RecordBatch:
        own = {}
        for side, doc_id, copies, h1, h2, text in held:  # a doc_id may have come with other texts or twice
            if doc_id not in own and _is_set(text, n, h1, h2):
                own[doc_id] = (side, copies, text)
        names = np.array(list(own), np.int64)
        sides, copies, texts = (list(c) for c in zip(*own.values(), strict=True))
        found = compare_block(texts, names, np.array(copies, np.int64), np.array(sides), now[1] == now[2], n, threshold)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["doc_id", "links", "root"])

    for batch in batches:
        for component, i, j, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (component, i, j) != now:
                if now is not None and len(held) > 1:
                    yield done()
                now, held = (component, i, j), []
            held.append(row)
    if len(held) > 1:
        yield done()


def _is_set(text: str | None, n: int, h1: int, h2: int) -> bool:
    data = np.frombuffer((text or "").encode(), np.uint8)
    one, two = set_hashes(*shingle_sets(data, np.array([0, len(data)]), n))
    return len(one) == 1 and int(one[0]) == h1 and int(two[0]) == h2


# ------------------------------------------------------------------ the operator


def block_counts(known: DataFrame, block_shingles: int = BLOCK_SHINGLES, block_texts: int = BLOCK_TEXTS) -> DataFrame:
    """(component, blocks): as many blocks as bound both the shingles and the texts of one, from rows of component and n_shingles."""
    by_shingles, by_texts = F.ceil(F.sum("n_shingles") / F.lit(block_shingles)), F.ceil(F.count("*") / F.lit(block_texts))
    return known.groupBy("component").agg(F.greatest(by_shingles, by_texts).alias("blocks"))


def near_duplicates(
    docs: DataFrame,
    n: int = SHINGLE,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    recall: float = RECALL,
    block_shingles: int = BLOCK_SHINGLES,
    block_texts: int = BLOCK_TEXTS,
) -> DataFrame:
    """One row for each doc_id: doc_id, class_id, links, copy_of.

    ``links`` is the number of other documents whose set of word shingles is at least ``threshold`` similar;
    ``copy_of`` the smallest doc_id with the same set, ``class_id`` the smallest doc_id reached over links. Words
    are runs without white space, as they are. Texts that are null or without a word are like nothing. Rows that
    repeat a doc_id count once; of different texts under one doc_id the one with the smallest hash counts. Rows
    without a doc_id are left out. Other columns are not read.
    """
    ready(docs.sparkSession)
    length = prefix_length(threshold, trees, LONGEST, recall)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id IS NOT NULL")
    signed = written(texts.mapInArrow(lambda b: sign_batches(b, n, trees, length), SIGNED), "signatures")
    one_text = signed.groupBy("doc_id").agg(F.min(F.struct("h1", "h2", "n_shingles", "keys")).alias("s")).select("doc_id", "s.*")
    # Written, so that the joins with it are of two plain shuffles, whose hot keys adaptive execution splits.
    heads = written(one_text.groupBy("h1", "h2").agg(F.min("doc_id").alias("copy_of"), F.count("*").alias("copies")), "class-heads")
    members = written(
        one_text.join(heads, ["h1", "h2"]).select("doc_id", "h1", "h2", "n_shingles", "copy_of", "copies", F.when(F.col("doc_id") == F.col("copy_of"), F.col("keys")).alias("keys")),
        "classes",
    )
    reps = members.filter("doc_id = copy_of")

    spread = reps.select("doc_id", F.posexplode("keys").alias("tree", "key"))
    buckets = spread.groupBy("tree", "key").agg(F.min("doc_id").alias("head"), F.count("*").alias("size")).filter("size > 1")
    buckets = written(buckets, "buckets")
    meets = spread.join(buckets, ["tree", "key"]).filter("doc_id <> head").select(F.col("doc_id").alias("a"), F.col("head").alias("b"))
    parts = connected(meets).select(F.col("node").alias("doc_id"), F.col("root").alias("component"))

    known = written(reps.drop("keys", "copy_of").join(parts, "doc_id"), "candidates")
    sizes = block_counts(known, block_shingles, block_texts)
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks"))
    placed = known.join(sizes, "component").withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    blocks = placed.select(
        "component",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).alias("side"),
        "doc_id",
        "copies",
        "h1",
        "h2",
    )
    order = ["component", "i", "j"]
    # The same plan at every size: texts are dealt by doc_id, whether or not few of them are candidates.
    filled = texts.join(blocks.hint("merge"), "doc_id").select(*order, "side", "doc_id", "copies", "h1", "h2", "text")
    compared = filled.repartition(*order).sortWithinPartitions(*order).mapInArrow(
        lambda b: compare_batches(b, n, threshold), "doc_id long, links long, root long"
    )
    linked = written(compared, "links")
    groups = connected(linked.select(F.col("doc_id").alias("a"), F.col("root").alias("b")))
    links = linked.groupBy("doc_id").agg(F.sum("links").alias("links"))
    found = links.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "full").select(F.col("doc_id").alias("copy_of"), "links", "root")
    rest = texts.select("doc_id").distinct().join(members.select("doc_id", "copy_of", "copies"), "doc_id", "left")
    return rest.join(found, "copy_of", "left").select(
        "doc_id",
        F.coalesce("root", "copy_of", "doc_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).alias("links"),
        F.coalesce("copy_of", "doc_id").alias("copy_of"),
    )
