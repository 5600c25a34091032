"""Remove passages that repeat across documents: count-min prefilter, exact grouping of what it lets through.

1. Each task counts its word windows in count-min rows; the partial sketches are merged shard by shard in the
   cluster. What is broadcast is one bit for each cell: its count is two or more. No repeated window is lost.
2. Windows that all rows call repeated are grouped exactly by a 96-bit key: first the smallest and largest doc_id
   of each key, combined in the tasks before the shuffle, then each window is compared with its key's smallest.
3. The positions found are brought together with their texts.

Keys, ids and positions travel as packed columns, one row for each bucket of keys and task, so that a window takes
about 20 bytes in a shuffle. A bucket is streamed: a key that a third of all documents hold passes through one
task, but is never held there.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ready, written
from tidemark.llm.words import mix, sequence_hashes, text_slices, word_bounds, word_hashes

WINDOW = 13
#: Count-min rows, and the cells of a row: twice the windows, at most MAX_CELLS (so 64 MB of bits are broadcast).
#: A fuller sketch lets more windows through to the exact grouping; none is lost.
ROWS = 2
MIN_CELLS = 1 << 20
MAX_CELLS = 1 << 28
SHARD = 1 << 20
#: Windows (candidates) a task holds before it passes them on.
FLUSH = 1 << 19
#: Windows to a bucket of keys, documents to a bucket of texts.
BUCKET_WINDOWS = 1 << 19
BUCKET_DOCS = 1 << 10
MIN_BUCKETS, MAX_BUCKETS = 1 << 9, 1 << 20

PACKED = "bucket int, kind int, a binary, b binary, c binary, d binary, e binary"


def planes(values: np.ndarray) -> bytes:
    """Bytes of numbers, all first bytes before all second bytes: equal high bytes compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def numbers(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _batch(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])


_PACKED = [("bucket", pa.int32()), ("kind", pa.int32()), *[(n, pa.binary()) for n in "abcde"]]


def _packed_rows(bucket: np.ndarray, kind: int, *columns: np.ndarray) -> list[tuple]:
    """One row for each bucket; ``bucket`` is ascending."""
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    edges = [0, *cuts.tolist(), len(bucket)] if len(bucket) else [0]
    rows = []
    for i, j in zip(edges[:-1], edges[1:], strict=True):
        blobs = [planes(c[i:j]) for c in columns]
        rows.append((int(bucket[i]), kind, *blobs, *[None] * (5 - len(blobs))))
    return rows


def by_bucket(df: DataFrame) -> DataFrame:
    return df.repartition("bucket").sortWithinPartitions("bucket", "kind")


# ------------------------------------------------------------------ windows


def windows(data: np.ndarray, offsets: np.ndarray, n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, text number, position in the text) of each window of ``n`` words, and the number of words of each text."""
    starts, ends, doc = word_bounds(data, offsets)
    first = np.searchsorted(doc, np.arange(len(offsets)))
    keys = sequence_hashes(word_hashes(data, starts, ends, seed), n, seed)
    whole = doc[: len(keys)] == doc[n - 1 : n - 1 + len(keys)]
    at = np.flatnonzero(whole)
    return keys[at], doc[at], at - first[doc[at]], np.diff(first)


def cells(keys: np.ndarray, row: int, n_cells: int) -> np.ndarray:
    return (mix(keys + np.uint64(row * 0x9E3779B97F4A7C15 % (1 << 64))) & np.uint64(n_cells - 1)).astype(np.uint32)


# ------------------------------------------------------------------ the sketch


def count_batches(batches: Iterator[pa.RecordBatch], n: int, n_cells: int) -> Iterator[pa.RecordBatch]:
    """Partial sketches as rows (shard number over all rows; packed gaps between the shard's cells; cells counted twice or more)."""
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        keys, out = np.concatenate(held), []
        for row in range(ROWS):
            own, counts = np.unique(cells(keys, row, n_cells), return_counts=True)
            shard = (own // SHARD).astype(np.int32) + row * (n_cells // SHARD)
            cuts = np.flatnonzero(np.diff(shard)) + 1
            edges = [0, *cuts.tolist(), len(shard)]
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                inside = own[i:j] % SHARD
                gaps = np.diff(inside, prepend=np.uint32(0)).astype(np.uint32)
                out.append((int(shard[i]), 0, planes(gaps), np.packbits(counts[i:j] > 1).tobytes(), None, None, None))
        return _batch(out, _PACKED)

    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column(0)):
            keys = windows(data, offsets, n)[0]
            held.append(keys)
            size += len(keys)
            if size >= 4 * FLUSH:
                yield flush()
                held, size = [], 0
    if size:
        yield flush()


def merge_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bit for each cell of each shard: counted twice or more, by one task or by two."""
    now, once, twice = None, None, None

    def done() -> pa.RecordBatch:
        return _batch([(now, np.packbits(twice, bitorder="little").tobytes())], [("bucket", pa.int32()), ("bits", pa.binary())])

    for batch in batches:
        for shard, gaps, many in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
            if shard != now:
                if now is not None:
                    yield done()
                now, once, twice = shard, np.zeros(SHARD, bool), np.zeros(SHARD, bool)
            at = np.cumsum(numbers(gaps, np.uint32), dtype=np.int64)
            twice[at] |= once[at] | np.unpackbits(np.frombuffer(many, np.uint8), count=len(at)).astype(bool)
            once[at] = True
    if now is not None:
        yield done()


@dataclass(frozen=True)
class Sketch:
    n_cells: int
    bits: list[np.ndarray]

    def repeated(self, keys: np.ndarray) -> np.ndarray:
        """Which windows may occur twice: those of which every row says so."""
        out = np.ones(len(keys), bool)
        for row, bits in enumerate(self.bits):
            at = cells(keys, row, self.n_cells)
            out &= (bits[at >> np.uint32(3)] >> (at & np.uint32(7)).astype(np.uint8) & 1).astype(bool)
        return out


def sketch(texts: DataFrame, n: int, n_cells: int) -> Sketch:
    parts = texts.select("text").mapInArrow(lambda batches: count_batches(batches, n, n_cells), PACKED)
    shards = by_bucket(parts).mapInArrow(merge_shards, "bucket int, bits binary")
    bits = [np.zeros(n_cells // 8, np.uint8) for _ in range(ROWS)]
    per_row, width = n_cells // SHARD, SHARD // 8
    for r in written(shards, "sketch").toLocalIterator():
        at = r.bucket % per_row * width
        bits[r.bucket // per_row][at : at + width] = np.frombuffer(r.bits, np.uint8)
    return Sketch(n_cells, bits)


# ------------------------------------------------------------------ exact grouping


def candidates(batches: Iterator[pa.RecordBatch], known: Sketch, n: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of (key, second key, doc_id, tag of the text, position) of windows that may be repeated."""
    held, size = [], 0
    for batch in batches:
        ids = np.array([x if x is not None else 0 for x in batch.column(0).to_pylist()], np.int64)
        named = ~np.array(batch.column(0).is_null())
        for first, last, data, offsets in text_slices(batch.column(1)):
            keys, doc, at, _ = windows(data, offsets, n)
            keep = np.flatnonzero(known.repeated(keys) & named[first:last][doc])
            if not len(keep):
                continue
            second = windows(data, offsets, n, seed=2)[0][keep].astype(np.uint32)
            tags = text_tags(data, offsets)
            held.append((keys[keep], second, ids[first:last][doc[keep]], tags[doc[keep]], at[keep].astype(np.uint32)))
            size += len(keep)
            if size >= FLUSH:
                yield tuple(map(np.concatenate, zip(*held, strict=True)))
                held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def text_tags(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sixteen bits of each text, which tell texts under one doc_id apart."""
    raw = data.tobytes()
    return np.array([zlib.crc32(raw[a:b]) & 0xFFFF for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], np.uint16)


def _bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    return (keys >> np.uint64(65 - n_buckets.bit_length())).astype(np.int32)


def extremes(keys: np.ndarray, second: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in ascending order with the least ``low`` and greatest ``high`` of each."""
    order = np.lexsort((second, keys))
    keys, second = keys[order], second[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (second[1:] != second[:-1])
    at = np.flatnonzero(first)
    return keys[at], second[at], np.minimum.reduceat(low[order], at), np.maximum.reduceat(high[order], at)


def extreme_rows(batches, known: Sketch, n: int, n_buckets: int) -> Iterator[pa.RecordBatch]:
    for keys, second, docs, _, _ in candidates(batches, known, n):
        keys, second, low, high = extremes(keys, second, docs, docs)
        yield _batch(_packed_rows(_bucket_of(keys, n_buckets), 0, keys, second, low, high - low), _PACKED)


def merge_extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket the keys that lie in two documents, with the smallest doc_id (as kind 0 of the next step)."""
    now, held, size = None, [], 0

    def merged() -> tuple[np.ndarray, ...]:
        return extremes(*map(np.concatenate, zip(*held, strict=True)))

    def done() -> Iterator[pa.RecordBatch]:
        keys, second, low, high = merged()
        keep = low < high
        if keep.any():
            yield _batch([(now, 0, planes(keys[keep]), planes(second[keep]), planes(low[keep]), None, None)], _PACKED)

    for batch in batches:
        for bucket, *blobs in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5)), strict=True):
            if bucket != now:
                if now is not None:
                    yield from done()
                now, held, size = bucket, [], 0
            keys, second, low, span = (numbers(x, t) for x, t in zip(blobs, (np.uint64, np.uint32, np.int64, np.int64), strict=True))
            held.append((keys, second, low, low + span))
            size += len(keys)
            if size > 4 * FLUSH:
                held = [merged()]
                size = len(held[0][0]) // 2
    if now is not None:
        yield from done()


def window_rows(batches, known: Sketch, n: int, n_buckets: int) -> Iterator[pa.RecordBatch]:
    for keys, *rest in candidates(batches, known, n):
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        yield _batch(_packed_rows(_bucket_of(keys, n_buckets), 1, keys, *(x[order] for x in rest)), _PACKED)


def later_rows(batches: Iterator[pa.RecordBatch], n_texts: int) -> Iterator[pa.RecordBatch]:
    """Windows whose key lies in a document with a smaller id, as rows (bucket of texts; doc_ids, tags, positions)."""
    now, table, held, size = None, None, [], 0

    def flush() -> pa.RecordBatch:
        docs, tags, at = map(np.concatenate, zip(*held, strict=True))
        own, inverse = np.unique(docs, return_inverse=True)
        bucket = np.array([text_bucket(int(d), n_texts) for d in own], np.int32)[inverse]
        order = np.lexsort((at, docs, bucket))
        return _batch(_packed_rows(bucket[order], 0, docs[order], tags[order], at[order]), _PACKED)

    for batch in batches:
        for bucket, kind, *blobs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != now:
                now, table = bucket, None
            if kind == 0:
                table = tuple(numbers(x, t) for x, t in zip(blobs[:3], (np.uint64, np.uint32, np.int64), strict=True))
            elif table is not None:
                keys, second, docs, tags, at = (
                    numbers(x, t) for x, t in zip(blobs, (np.uint64, np.uint32, np.int64, np.uint16, np.uint32), strict=True)
                )
                later = _smallest(table, keys, second) < docs
                if later.any():
                    held.append((docs[later], tags[later], at[later]))
                    size += int(later.sum())
                    if size >= FLUSH:
                        yield flush()
                        held, size = [], 0
    if held:
        yield flush()


def _smallest(table: tuple[np.ndarray, ...], keys: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The smallest doc_id of each key; the largest int where the key is not in the table (ordered by both keys)."""
    known, known_second, low = table
    out = np.full(len(keys), np.iinfo(np.int64).max)
    at = np.searchsorted(known, keys)
    open_ = np.flatnonzero(at < len(known))
    while len(open_):  # equal first keys with another second key lie beside each other
        here = at[open_]
        same = known[here] == keys[open_]
        hit = same & (known_second[here] == second[open_])
        out[open_[hit]] = low[here[hit]]
        open_ = open_[same & ~hit]
        at[open_] += 1
        open_ = open_[at[open_] < len(known)]
    return out


def text_bucket(doc_id: int, n_texts: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % n_texts


# ------------------------------------------------------------------ texts


def cut_texts(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Texts without their removed words, from rows of positions (kind 0) and, after them, texts (kind 1) of each bucket."""
    now, held, table = None, [], None
    kinds = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())]
    for batch in batches:
        out = []
        for bucket, kind, docs, tags, at, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != now:
                now, held, table = bucket, [], None
            if kind == 0:
                held.append((numbers(docs, np.int64), numbers(tags, np.uint16), numbers(at, np.uint32)))
                continue
            if table is None:
                table = _by_document(held)
            raw = (text or "").encode()
            words = raw.split()
            removed = table.get((doc_id, zlib.crc32(raw) & 0xFFFF))
            if removed is not None and words:
                depth = np.zeros(len(words) + n + 1, np.int64)
                np.add.at(depth, removed, 1)
                np.add.at(depth, removed + n, -1)
                gone = np.cumsum(depth)[: len(words)] > 0
                kept = [w for w, x in zip(words, gone.tolist(), strict=True) if not x]
            else:
                kept = words
            out.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode()))
        if out:
            yield _batch(out, kinds)


def _by_document(held: list[tuple[np.ndarray, ...]]) -> dict[tuple[int, int], np.ndarray]:
    if not held:
        return {}
    docs, tags, at = map(np.concatenate, zip(*held, strict=True))
    order = np.lexsort((tags, docs))
    docs, tags, at = docs[order], tags[order], at[order].astype(np.int64)
    cuts = np.flatnonzero((np.diff(docs) != 0) | (np.diff(tags) != 0)) + 1
    edges = [0, *cuts.tolist(), len(docs)]
    return {(int(docs[i]), int(tags[i])): at[i:j] for i, j in zip(edges[:-1], edges[1:], strict=True)}


def _power_of_two(x: int, least: int, most: int) -> int:
    return min(most, max(least, 1 << max(0, int(x) - 1).bit_length()))


def remove_repeats(docs: DataFrame, window: int = WINDOW, max_cells: int = MAX_CELLS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, text of the kept words joined by a blank.

    A word goes if a window of ``window`` words that covers it also starts in a document with a smaller doc_id.
    Windows are judged on the input; a repetition within one document alone removes nothing. Null and empty texts
    have no words; texts of fewer than ``window`` words stay whole; a row without a doc_id stays whole and removes
    nothing elsewhere; rows of one doc_id never remove from each other. Other columns are not read.
    """
    spark: SparkSession = ready(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    about = size.bytes // 6
    n_cells = _power_of_two(2 * about, MIN_CELLS, max_cells)
    n_buckets = _power_of_two(about // BUCKET_WINDOWS, MIN_BUCKETS, MAX_BUCKETS)
    n_texts = _power_of_two(size.n // BUCKET_DOCS, MIN_BUCKETS, MAX_BUCKETS)
    known = spark.sparkContext.broadcast(sketch(texts, window, n_cells))

    lows = by_bucket(texts.mapInArrow(lambda b: extreme_rows(b, known.value, window, n_buckets), PACKED))
    repeated = written(lows.mapInArrow(merge_extremes, PACKED), "repeated-windows")
    spots = texts.mapInArrow(lambda b: window_rows(b, known.value, window, n_buckets), PACKED)
    later = by_bucket(spots.unionByName(repeated)).mapInArrow(lambda b: later_rows(b, n_texts), PACKED)
    gone = written(later, "removed-windows")

    bucket = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n_texts)).cast("int"), F.lit(0))
    whole = texts.select(bucket.alias("bucket"), F.lit(1).alias("kind"), *[F.lit(None).cast("binary").alias(c) for c in "abc"], "doc_id", "text")
    cut = gone.select("bucket", "kind", "a", "b", "c", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    together = by_bucket(whole.unionByName(cut))
    return together.mapInArrow(lambda b: cut_texts(b, window), "doc_id long, n_words long, n_removed long, text string")
