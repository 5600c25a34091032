"""Quality of documents: ridge regression on random Fourier features of document statistics, calibrated by isotonic regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import crc_mod, ready, written
from tidemark.llm.words import text_slices, word_bounds, word_hashes

#: Labelled rows the classifier is fitted on at most, about; chosen by the hash of doc_id.
TRAIN_ROWS = 200_000
FOURIER = 192
WIDTH = 4.0
RIDGE = 1e-3
FOLDS = 4
ACCEPT = 0.3
SEED = 11
#: Partial sums of the normal equations: one matrix from each of so many tasks.
TRAIN_TASKS = 16
#: Raw scores are counted in bins of this width for calibration.
BIN = 0.002


def _class(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode(), np.uint8)


BYTE_CLASSES = (
    np.arange(0x41, 0x5B), np.arange(0x61, 0x7B), np.arange(0x30, 0x3A), np.arange(0x80, 0x100), _class(" \t"), _class("\n\r"),
    _class(".,;:"), _class("!?"), _class("#$%&*@^~+="), _class("|<>{}[]\\/_"), _class("'\"()-"),
)
LINES = np.zeros(256, bool)
LINES[[0x0A, 0x0D]] = True
N_STATS = len(BYTE_CLASSES) + 8


# ------------------------------------------------------------------ statistics of texts


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of N_STATS numbers for each text: shares of kinds of characters, lengths, repetition of words and lines."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    out = np.zeros((n, N_STATS))
    for k, members in enumerate(BYTE_CLASSES):
        one = np.zeros(256, bool)
        one[members] = True
        sums = np.concatenate([[0], np.cumsum(one[data])])
        out[:, k] = np.diff(sums[offsets]) / np.maximum(size, 1)
    starts, ends, doc = word_bounds(data, offsets)
    words = np.bincount(doc, minlength=n).astype(float)
    hashes = word_hashes(data, starts, ends)
    line_starts, line_ends, line_doc = word_bounds(data, offsets, LINES)
    lines = np.bincount(line_doc, minlength=n).astype(float)
    same = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1]) if len(hashes) else np.zeros(0, bool)
    long = np.bincount(doc, weights=(ends - starts) > 20, minlength=n)
    k = len(BYTE_CLASSES)
    out[:, k] = np.log1p(size)
    out[:, k + 1] = np.log1p(words)
    out[:, k + 2] = np.bincount(doc, weights=ends - starts, minlength=n) / np.maximum(words, 1) / 10
    out[:, k + 3] = _distinct(doc, hashes, n) / np.maximum(words, 1)
    out[:, k + 4] = np.bincount(doc[1:][same], minlength=n) / np.maximum(words, 1) if len(same) else 0
    out[:, k + 5] = _distinct(line_doc, word_hashes(data, line_starts, line_ends), n) / np.maximum(lines, 1)
    out[:, k + 6] = np.log1p(words / np.maximum(lines, 1))
    out[:, k + 7] = long / np.maximum(words, 1)
    return out


def _distinct(doc: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((hashes, doc))
    d, h = doc[order], hashes[order]
    first = np.ones(len(d), bool)
    first[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    return np.bincount(d[first], minlength=n)


def batch_statistics(column) -> np.ndarray:
    parts = [statistics(data, offsets) for _, _, data, offsets in text_slices(column)]
    return np.concatenate(parts) if parts else np.zeros((0, N_STATS))


def _floats(rows: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(rows).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), flat)


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, stats of each row of ``docs``; whole texts, null as empty."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _floats(batch_statistics(batch.column(1)))], names=["doc_id", "stats"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, stats array<double>")


# ------------------------------------------------------------------ the model


@dataclass(frozen=True)
class Model:
    """Standardisation, Fourier directions and phases, ridge weights, and the calibration curve (raw, score)."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    curve: tuple[np.ndarray, np.ndarray]

    def raw(self, stats: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return fourier(stats, self) @ (self.weights if weights is None else weights)

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), *self.curve), 0.0, 1.0)


def fourier(stats: np.ndarray, model: Model) -> np.ndarray:
    """Cosines whose inner products approximate a Gaussian kernel, and a constant."""
    x = np.clip((stats - model.mean) / model.scale, -8, 8)
    z = np.sqrt(2 / FOURIER) * np.cos(x @ model.directions + model.phases)
    return np.concatenate([z, np.ones((len(z), 1))], axis=1)


def isotonic(raw: np.ndarray, share: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over ascending ``raw``; points at the weighted middle of each pool."""
    pools: list[list[float]] = []
    for r, s, w in zip(raw, share, weight, strict=True):
        pools.append([r * w, s * w, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def train(stats: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on rows of ``stats`` (doc_id, stats) that have a label (doc_id, quality 0 or 1). Rows without a label teach nothing.

    Normal equations are summed by task and then by fold. Each fold's raw scores come from weights fitted without
    it, and the calibration curve is fitted on those scores. What comes to the driver: FOLDS matrices and one row
    for each bin of raw scores. Without labels the score is 0.5.
    """
    spark = ready(stats.sparkSession)
    known = labels.filter("quality IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y"))
    every = max(1, -(-known.count() // train_rows))
    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    fold = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(FOLDS)).cast("int")
    rows = written(stats.join(sample, "doc_id").select(fold.alias("fold"), "y", "stats"), "quality-train").repartition(TRAIN_TASKS)
    moments = rows.agg(
        *[f(F.col("stats")[i]).alias(f"{n}{i}") for i in range(N_STATS) for n, f in (("m", F.mean), ("s", F.stddev_pop))]
    ).first()
    rng = np.random.default_rng(SEED)
    model = Model(
        np.array([moments[f"m{i}"] or 0.0 for i in range(N_STATS)]),
        np.array([max(moments[f"s{i}"] or 0.0, 1e-3) for i in range(N_STATS)]),
        rng.normal(size=(N_STATS, FOURIER)) / WIDTH,
        rng.uniform(0, 2 * np.pi, FOURIER),
        np.zeros(FOURIER + 1),
        (np.array([0.0]), np.array([0.5])),
    )
    shared = spark.sparkContext.broadcast(model)
    side = FOURIER + 2

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((FOLDS, side, side))
        for batch in batches:
            folds, y, x = _training(batch)
            zy = np.concatenate([fourier(x, shared.value), y[:, None]], axis=1)
            for f in range(FOLDS):
                own = zy[folds == f]
                sums[f] += own.T @ own
        blobs = pa.array([s.tobytes() for s in sums], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(range(FOLDS), pa.int32()), blobs], names=["fold", "sums"])

    def total(table: pa.Table) -> pa.Table:
        summed = sum(np.frombuffer(b.as_py()) for b in table["sums"])
        return pa.table({"fold": pa.array([table["fold"][0].as_py()], pa.int32()), "sums": pa.array([summed.tobytes()], pa.binary())})

    schema = "fold int, sums binary"
    totals = rows.mapInArrow(partial, schema).groupBy("fold").applyInArrow(total, schema).collect()
    by_fold = {r.fold: np.frombuffer(r.sums).reshape(side, side) for r in totals}
    every_fold = sum(by_fold.values()) if by_fold else np.zeros((side, side))
    if every_fold[-2, -2] == 0:
        return model
    fitted = spark.sparkContext.broadcast([_solve(every_fold - by_fold.get(f, 0)) for f in range(FOLDS)])

    def unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folds, y, x = _training(batch)
            z = fourier(x, shared.value)
            raw = np.einsum("ij,ij->i", z, np.array(fitted.value)[folds]) if len(folds) else np.zeros(0)
            bins = np.round(np.clip(raw, -1, 2) / BIN).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(y)], names=["bin", "y"])

    bins = rows.mapInArrow(unseen, "bin int, y double").groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("y")).orderBy("bin").collect()
    raw, n, y = (np.array(c, float) for c in zip(*[(r.bin * BIN, r.n, r.y) for r in bins], strict=True))
    return Model(model.mean, model.scale, model.directions, model.phases, _solve(every_fold), isotonic(raw, y / n, n))


def _training(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2))


def _matrix(lists) -> np.ndarray:
    return lists.flatten().to_numpy().reshape(len(lists), N_STATS)


def _solve(sums: np.ndarray) -> np.ndarray:
    """Ridge weights from summed normal equations; the constant is not shrunk."""
    a, b = sums[:-1, :-1], sums[:-1, -1]
    penalty = np.full(len(a), RIDGE * max(sums[-2, -2], 1))
    penalty[-1] = 1e-9
    return np.linalg.solve(a + np.diag(penalty), b)


# ------------------------------------------------------------------ scoring


def score_statistics(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of each row of doc_id, stats."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(_matrix(batch.column(1))))], names=["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")


def score_documents(docs: DataFrame, model: Model, column: str = "score", least: float | None = None) -> DataFrame:
    """``docs`` with a score in ``column`` (replaced if there); with ``least``, only rows of that score or more.

    Null and empty texts get the score of their statistics, which are zeros. Rows pass through in place: no shuffle.
    """
    spark = ready(docs.sparkSession)
    docs = docs.drop(column)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score(batch_statistics(batch.column(at)))
            scored = pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, column])
            yield scored if least is None else scored.filter(pa.array(scores >= least))

    return docs.mapInArrow(run, schema)


def learnable(labels: DataFrame) -> DataFrame:
    """Labels the contract lets the classifier see."""
    return labels.filter(crc_mod("doc_id", 5) != 0)
