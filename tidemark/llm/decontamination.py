"""Find benchmark passages in documents with one Aho-Corasick automaton, scanning each text once."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ready, written
from tidemark.llm.words import text_slices, word_bounds

WINDOW = 10
#: Bytes of distinct windows in one automaton; a larger benchmark is scanned in several blocks of this size.
BLOCK_BYTES = 16 << 20

#: Words: runs of bytes that are not separators, after lower-casing A-Z.
SEPARATOR = np.ones(256, bool)
SEPARATOR[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_lower = np.arange(256, dtype=np.uint8)
_lower[0x41:0x5B] += 32
LOWER = _lower.tobytes()

FOUND = "doc_id long, n_words long, n_hit long, items array<long>, spans array<array<long>>"
#: Between two blocks of a large benchmark: ``runs`` are the hit words so far as [first, last + 1).
STATE = FOUND + ", text string, runs array<array<long>>"


def normal_words(text: str | None) -> list[str]:
    """The words of one text (for the benchmark's few items and for tests)."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(LOWER)
    starts, ends, _ = word_bounds(np.frombuffer(data, np.uint8), np.array([0, len(data)]), SEPARATOR)
    return [data[s:e].decode("utf-8", "surrogatepass") for s, e in zip(starts, ends, strict=True)]


def windows(items: list[tuple[int, str | None]], n: int = WINDOW) -> dict[str, set[int]]:
    """Window text -> ids of the items that have it. An item of fewer than ``n`` words, but not none, is one window."""
    found: dict[str, set[int]] = {}
    for item, text in items:
        words = normal_words(text)
        for i in range(max(1, len(words) - n + 1) if words else 0):
            found.setdefault(" ".join(words[i : i + n]), set()).add(item)
    return found


def blocks(found: dict[str, set[int]], block_bytes: int = BLOCK_BYTES) -> list[list[tuple[str, list[int]]]]:
    out: list[list[tuple[str, list[int]]]] = [[]]
    size = 0
    for window in sorted(found):
        if size > block_bytes:
            out.append([])
            size = 0
        out[-1].append((window, sorted(found[window])))
        size += len(window.encode())
    return out


_built: dict[str, object] = {}


def _automaton(name: str, patterns: list[tuple[str, list[int]]]):
    """One automaton at a time is kept by a worker, under a name that no other set of patterns has. Bytes stand for themselves as Latin-1 characters."""
    import ahocorasick

    if name not in _built:
        _built.clear()
        machine = ahocorasick.Automaton()
        for i, (window, _) in enumerate(patterns):
            key = f" {window} ".encode().decode("latin-1")
            machine.add_word(key, (i, len(key)))
        machine.make_automaton()
        _built[name] = machine
    return _built[name]


def _scan(machine, patterns, normal: bytes) -> tuple[list[tuple[int, int]], set[int]]:
    """Byte ranges of the occurrences in one normalised text, and the ids of their items."""
    ranges, hit = [], set()
    for end, (i, size) in machine.iter(normal.decode("latin-1")):
        ranges.append((end - size + 1, end))
        hit.add(i)
    return ranges, {item for i in hit for item in patterns[i][1]}


def scan_batches(
    batches: Iterator[pa.RecordBatch], name: str, patterns: list[tuple[str, list[int]]], last: bool = True
) -> Iterator[pa.RecordBatch]:
    """Rows of FOUND (STATE if not the last block) for rows of doc_id, text and, after the first block, items and runs."""
    machine = _automaton(name, patterns) if patterns else None
    names, kinds = zip(*_ARROW[: 5 if last else 7], strict=True)
    for batch in batches:
        ids, column = batch.column(0).to_pylist(), batch.column(1)
        before = list(zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)) or [([], [])] * len(ids)
        for first, end, data, offsets in text_slices(column):
            lowered = np.frombuffer(data.tobytes().translate(LOWER), np.uint8)
            starts, ends, _ = word_bounds(lowered, offsets, SEPARATOR)
            bound = np.searchsorted(starts, offsets)
            rows = []
            for k in range(end - first):
                at = slice(bound[k], bound[k + 1])
                s, e = starts[at] - offsets[k], ends[at] - offsets[k]
                items, runs = before[first + k]
                found, ranges = set(items), []
                if len(s) and machine is not None:
                    text = lowered[offsets[k] : offsets[k + 1]].tobytes()
                    normal = b" " + b" ".join([text[i:j] for i, j in zip(s.tolist(), e.tolist(), strict=True)]) + b" "
                    ranges, new = _scan(machine, patterns, normal)
                    found |= new
                n_hit, spans = 0, []
                if ranges or runs:
                    covered = _covered(normal, ranges, runs, len(s))
                    n_hit, runs = int(covered.sum()), _runs(covered)
                    spans = _spans(runs, data[offsets[k] : offsets[k + 1]], s, e)
                rows.append((ids[first + k], len(s), n_hit, sorted(found), spans) + (() if last else (column[first + k].as_py(), runs)))
            arrays = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=list(names))


_PAIRS = pa.list_(pa.list_(pa.int64()))
_ARROW = [
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())),
    ("spans", _PAIRS), ("text", pa.string()), ("runs", _PAIRS),
]


def _covered(normal: bytes, ranges: list[tuple[int, int]], runs: list[list[int]], n_words: int) -> np.ndarray:
    """Which words lie in a byte range, from the blank before its first word to the one after its last, or in a run of words."""
    depth = np.zeros(n_words + 1, np.int64)
    if ranges:
        blanks = np.flatnonzero(np.frombuffer(normal, np.uint8) == 0x20)
        edges = np.searchsorted(blanks, np.asarray(ranges))
        np.add.at(depth, edges[:, 0], 1)
        np.add.at(depth, edges[:, 1], -1)
    for first, end in runs:
        depth[first] += 1
        depth[end] -= 1
    return np.cumsum(depth)[:n_words] > 0


def _runs(covered: np.ndarray) -> list[list[int]]:
    edge = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    return [[int(a), int(b)] for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]


def _spans(runs: list[list[int]], original: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
    """Runs of words as code points [start, end) of the original text."""
    points = np.concatenate([[0], np.cumsum((original & 0xC0) != 0x80)])
    return [[int(points[starts[a]]), int(points[ends[b - 1]])] for a, b in runs]


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, items (ids of items with a window in the text), spans.

    ``spans`` are [start, end) in code points of the original text and cover the hit words. A null or empty text
    has no words; an item without words has no window, repeated items count once by id, items without an id are
    left out; an empty benchmark gives no hits. Rows are returned once each, also repeated ones, and other
    columns are not read.

    The benchmark is the stated query set: its distinct windows go to the workers in blocks of ``block_bytes``,
    almost always one. With more blocks the texts are scanned once for each, and what was found so far travels
    with the row. What is broadcast never exceeds a block.
    """
    ready(docs.sparkSession)
    parts = benchmark_blocks(benchmark, window, block_bytes)
    state = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for patterns in parts[:-1]:
        state = written(_scanned(state, patterns, False), "decontamination").select("doc_id", "text", "items", "runs")
    return _scanned(state, parts[-1], True)


def benchmark_blocks(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> list[list[tuple[str, list[int]]]]:
    items = [(r.item_id, r.text) for r in benchmark.select("item_id", "text").filter("item_id IS NOT NULL").toLocalIterator()]
    return blocks(windows(items, window), block_bytes)


def without_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` without an occurrence of a benchmark window, with all their columns and without a shuffle."""
    spark = ready(docs.sparkSession)
    for patterns in benchmark_blocks(benchmark, window, block_bytes):
        name = uuid.uuid4().hex
        shared = spark.sparkContext.broadcast(patterns)
        at = docs.columns.index("text")

        def run(batches, name=name, shared=shared, at=at):
            for batch in batches:
                ids = pa.array(range(len(batch)), pa.int64())
                texts = pa.RecordBatch.from_arrays([ids, batch.column(at)], names=["doc_id", "text"])
                clean = [n == 0 for found in scan_batches(iter([texts]), name, shared.value) for n in found.column(2).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def _scanned(state: DataFrame, patterns: list[tuple[str, list[int]]], last: bool) -> DataFrame:
    name = uuid.uuid4().hex
    shared = state.sparkSession.sparkContext.broadcast(patterns)

    def run(batches):
        return scan_batches(batches, name, shared.value, last)

    return state.mapInArrow(run, FOUND if last else STATE)
