"""Ranked lexical search: documents grouped by the mask of the terms they hold, masks taken by descending maximum score.

A first pass counts the terms of every document that some item asks for, with the length of the document. N, L and the
document frequencies follow from that table. In the second pass a task holds a slice of documents as a matrix of terms
by documents. For each item the presence rows of its terms are packed into one bit mask a document; documents of one
mask are a group. The most that a mask can score is the sum, over its terms, of the weight times the largest factor
that any document of the slice has for the term. Groups are scored exactly in descending order of that bound until
the next bound is below the worst score the item keeps: what is left cannot enter. The kept scores go on from slice to
slice, so that most masks of later slices are never looked at. A task gives at most ``k`` rows an item.

Items are taken in blocks with a bounded number of terms, one pass over the documents for each block; only the terms of
a block are on the driver and with the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ready, written
from tidemark.llm.words import text_slices, word_bounds, word_hashes

TOP = 50
#: Terms of all items of a block, repeats included.
BLOCK_TERMS = 200_000
#: Cells of the matrix of terms by documents of a slice.
SLICE_CELLS = 8_000_000
MOST_DOCS = 4096
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes between terms: ASCII other than digits and letters. Letters are lower-cased before.
BETWEEN = np.zeros(256, bool)
BETWEEN[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 0x20

# ------------------------------------------------------------------ terms


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): the distinct terms of all texts of an item_id, sorted; items without a term are left out."""
    lowered = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER_CASE)
    each = items.select("item_id", F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term"))
    return each.groupBy("item_id").agg(F.array_sort(F.collect_set("term")).alias("terms"))


def hashes_of(terms: list[str]) -> np.ndarray:
    data = "".join(terms).encode()
    sizes = np.array([len(t.encode()) for t in terms], np.int64)
    ends = np.cumsum(sizes)
    return word_hashes(np.frombuffer(data, np.uint8), ends - sizes, ends)


COUNTED = "doc_id long, n long, terms array<int>, counts array<int>"


def count_batches(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of COUNTED for the texts that have a term; ``terms`` are places in the sorted hashes ``vocabulary``."""
    for batch in batches:
        ids = batch.column(0)
        for a, b, data, offsets in text_slices(batch.column(1)):
            low = LOWERED[data]
            starts, ends, doc = word_bounds(low, offsets, BETWEEN)
            if not len(starts):
                continue
            total = np.bincount(doc, minlength=b - a)
            hashes = word_hashes(low, starts, ends)
            at = np.searchsorted(vocabulary[:-1], hashes)
            asked = vocabulary[at] == hashes
            cell, count = np.unique(doc[asked] * len(vocabulary) + at[asked], return_counts=True)
            some = np.flatnonzero(total)
            cuts = pa.array(np.searchsorted(cell, np.append(some, b - a) * len(vocabulary)), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array((x).astype(np.int32))) for x in (cell % len(vocabulary), count)]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(some + a)), pa.array(total[some]), *lists], names=["doc_id", "n", "terms", "counts"])


# ------------------------------------------------------------------ scores of a task


class Best:
    """The ``k`` best rows of an item so far: highest score first, then smallest doc_id, a null one last."""

    def __init__(self, k: int):
        self.k = k
        self.score = self.doc = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def least(self) -> int:
        """A row needs so much to enter (equal scores may enter by doc_id)."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        use = score >= self.least()
        if use.any():
            score, doc, null = np.append(self.score, score[use]), np.append(self.doc, doc[use]), np.append(self.null, null[use])
            order = np.lexsort((doc, null, -score))[: self.k]
            self.score, self.doc, self.null = score[order], doc[order], null[order]


def masks_of(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct masks as rows of bits, mask number of each document) from presence rows of an item's terms."""
    packed = np.packbits(present, axis=0).T
    wide = np.zeros((packed.shape[0], -(-packed.shape[1] // 8) * 8), np.uint8)
    wide[:, : packed.shape[1]] = packed
    keys = wide.view(np.uint64)[:, 0] if wide.shape[1] == 8 else wide.view(f"V{wide.shape[1]}")[:, 0]
    _, first, group = np.unique(keys, return_index=True, return_inverse=True)
    return np.unpackbits(packed[first], axis=1)[:, : len(present)].astype(bool), group


def search_slice(best: list[Best], items: list[np.ndarray], weights: np.ndarray, doc, null, m, lengths, terms, counts) -> None:
    """Let the documents of a slice compete. ``terms`` and ``counts`` are those of all documents, one after another."""
    factor = np.zeros((len(weights), len(doc)), np.int32)
    column = np.repeat(np.arange(len(doc)), lengths)
    tf = counts.astype(np.int64)
    factor[terms, column] = (1_000_000_000 * tf) // (1000 * tf + 20 * m[column])
    present = np.zeros(factor.shape, bool)
    present[terms, column] = True
    most = weights * factor.max(axis=1, initial=0)
    for top, rows in zip(best, items, strict=True):
        if not present[rows].any():
            continue
        masks, group = masks_of(present[rows])
        bound = masks @ most[rows]
        order = np.argsort(-bound, kind="stable")
        size = np.bincount(group, minlength=len(masks))
        by_mask = np.argsort(group, kind="stable")
        start = np.cumsum(size) - size
        at, wanted = 0, top.k
        while at < len(order) and bound[order[at]] >= top.least():
            # The next masks that hold as many documents as are wanted, then twice as many, and so on.
            upto = at + 1 + int(np.searchsorted(np.cumsum(size[order[at:]]), wanted))
            use = order[at:upto]
            use = use[bound[use] >= top.least()]
            docs = np.concatenate([by_mask[start[g] : start[g] + size[g]] for g in use])
            score = weights[rows] @ factor[np.ix_(rows, docs)].astype(np.int64)
            top.add(score, doc[docs], null[docs])
            at, wanted = upto, wanted * 2


def search_batches(batches: Iterator[pa.RecordBatch], items: list[np.ndarray], weights: np.ndarray, n: int, length: int, k: int, most_docs: int) -> Iterator[pa.RecordBatch]:
    """Rows (item, doc_id, score): the ``k`` best of the task for each item, from rows of COUNTED."""
    best = [Best(k) for _ in items]
    most_docs = max(1, min(most_docs, SLICE_CELLS // len(weights)))
    for batch in batches:
        for a in range(0, batch.num_rows, most_docs):
            part = batch.slice(a, most_docs)
            ids = part.column(0)
            lists = [part.column(c) for c in (2, 3)]
            size = part.column(1).to_numpy(zero_copy_only=False)
            search_slice(
                best, items, weights, ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False),
                50 + (50 * size * n) // length, np.diff(lists[0].offsets.to_numpy()), *[x.flatten().to_numpy() for x in lists],
            )
    for item, top in enumerate(best):
        if len(top.score):
            columns = [pa.array(np.full(len(top.score), item, np.int32)), pa.array(top.doc, mask=top.null), pa.array(top.score)]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])


# ------------------------------------------------------------------ the operator


def search_block(counted: DataFrame, listed: list, vocabulary: list[str], k: int, most_docs: int) -> DataFrame | None:
    """The ``k`` best documents of each item of a block; None if no document has a term."""
    total = counted.agg(F.count("*").alias("n"), F.sum("n").alias("length")).first()
    if not total.n:
        return None
    # One row a term of the block.
    holding = dict(counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weights = np.array([math.floor(1000 * math.log((2 * total.n + 2) / (2 * holding.get(t, 0) + 1))) for t in range(len(vocabulary))], np.int64)
    place = {term: t for t, term in enumerate(vocabulary)}
    items = [np.array([place[t] for t in row.terms]) for row in listed]
    n, length = total.n, total.length
    found = counted.mapInArrow(lambda b: search_batches(b, items, weights, n, length, k, most_docs), "item int, doc_id long, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS, most_docs: int = MOST_DOCS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` highest scores above 0 of each item, from rank 1, ties by ascending doc_id.

    Terms are runs of digits, ASCII letters (A-Z lower-cased) and characters beyond ASCII; null texts have none. Rows
    of one item_id are one item with the terms of all its texts, a null item_id included; items without a term, or with
    terms that no document has, have no row. Every row of ``docs`` is a document of its own: rows that repeat a doc_id
    may both be listed, and a null doc_id comes last among equal scores. No documents, or none with a term, give an
    empty table. Other columns are not read. Terms are told apart by 64-bit hashes.
    """
    spark = ready(docs.sparkSession)
    asked = written(item_terms(items), "search-items")
    blocks = max(1, math.ceil((asked.agg(F.sum(F.size("terms"))).first()[0] or 0) / block_terms))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = asked.select(F.lit(0).alias("item"), "item_id").schema
    parts = []
    for block in range(blocks):
        listed = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        if not listed:
            continue
        terms = sorted({t for row in listed for t in row.terms})
        hashes = hashes_of(terms)
        order = np.argsort(hashes)
        counted = written(texts.mapInArrow(lambda b, v=hashes[order]: count_batches(b, v), COUNTED), "search-counts")
        found = search_block(counted, listed, [terms[i] for i in order], k, most_docs)
        if found is not None:
            names = spark.createDataFrame([(i, row.item_id) for i, row in enumerate(listed)], schema)
            parts.append(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return asked.filter("false").select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
