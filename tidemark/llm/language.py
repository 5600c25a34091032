"""Language of texts: words scored by frequency in each language, unseen words by ever shorter character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ready

UNKNOWN = "und"
#: Labelled documents of each language the model is fitted on at most, about; chosen by the hash of doc_id, all of a rarer language.
TRAIN_DOCS = 20_000
#: Words and n-grams of each language in the model at most, about: its most frequent ones; all others are scored by shorter n-grams.
MODEL_WORDS = 100_000
MODEL_GRAMS = 100_000
LONGEST = 4
#: Words whose evidence the score counts at most, so that long texts do not all get 1.
EVIDENCE_WORDS = 20
KNOWN_WORDS = 200_000
#: Steps in which the share of units that tie is taken by hash.
HASHES = 1 << 20


@dataclass(frozen=True)
class Model:
    """Languages, and log frequency by language of each word and n-gram (rows of one matrix)."""

    languages: tuple[str, ...]
    words: dict[str, int]
    grams: dict[str, int]
    logs: np.ndarray


def train(
    labelled: DataFrame, train_docs: int = TRAIN_DOCS, model_words: int = MODEL_WORDS, model_grams: int = MODEL_GRAMS
) -> Model:
    """Count words and padded n-grams by language over rows of doc_id, text, lang. Rows without text or lang teach nothing.

    All three bounds are for each language. Counting is a Spark job; what comes to the driver are the counts, in every
    language, of the units that are among the most frequent ``model_words`` or ``model_grams`` of one.
    """
    taught = labelled.filter("text IS NOT NULL AND lang IS NOT NULL")
    every = {r.lang: -(-r["count"] // train_docs) for r in taught.groupBy("lang").count().collect()}
    large = {lang: n for lang, n in every.items() if n > 1}
    sample = taught
    if large:
        one_in = F.create_map(*[F.lit(x) for pair in sorted(large.items()) for x in pair])
        sample = taught.filter(F.pmod(F.xxhash64("doc_id"), F.coalesce(F.element_at(one_in, F.col("lang")), F.lit(1))) == 0)
    words = (
        sample.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("unit"))
        .filter("unit <> ''")
        .groupBy("lang", "unit")
        .count()
        .persist()
    )
    try:
        padded = F.concat(F.lit(" "), F.col("unit"), F.lit(" "))
        starts = F.transform(
            F.sequence(F.lit(1), F.lit(LONGEST)),
            lambda n: F.when(
                F.length(padded) >= n,
                F.transform(F.sequence(F.lit(1), F.length(padded) - n + 1), lambda i: F.substr(padded, i, n)),
            ).otherwise(F.array().cast("array<string>")),
        )
        grams = words.select("lang", "count", F.explode(F.flatten(starts)).alias("unit")).groupBy("lang", "unit").agg(F.sum("count").alias("count"))
        word_rows, gram_rows = _frequent(words, model_words), _frequent(grams, model_grams)
    finally:
        words.unpersist()
    return build(word_rows, gram_rows)


def _frequent(counts: DataFrame, most: int) -> list[tuple[str, str, int]]:
    """Rows (lang, unit, count) of the units that are among about ``most`` of the largest counts of some language.

    Only how often each count occurs in a language comes to the driver to find where to cut. Units that tie there are
    taken by hash, as large a share as there is room for.
    """
    ties: dict[str, list[tuple[int, int]]] = {}
    for lang, count, units in counts.groupBy("lang", "count").agg(F.count("*")).collect():
        ties.setdefault(lang, []).append((count, units))
    cuts = []
    for lang, found in ties.items():
        room, cut = most, (0, 0)
        for count, units in sorted(found, reverse=True):
            if units > room:
                cut = (count, HASHES * room // units)
                break
            room -= units
        cuts.append((lang, *cut))
    at = counts.sparkSession.createDataFrame(cuts, "lang string, least long, below long")
    own = (F.col("count") > F.col("least")) | ((F.col("count") == F.col("least")) & (F.pmod(F.xxhash64("unit"), F.lit(HASHES)) < F.col("below")))
    top = counts.join(F.broadcast(at), "lang").filter(own).select("unit").distinct()
    table = counts.join(top, "unit").select("lang", "unit", "count").toArrow()
    return list(zip(*(c.to_pylist() for c in table.columns), strict=True))


def build(word_rows: list[tuple[str, str, int]], gram_rows: list[tuple[str, str, int]]) -> Model:
    """Model from (language, word, count) and (language, n-gram, count)."""
    languages = tuple(sorted({r[0] for r in word_rows}))
    place = {lang: i for i, lang in enumerate(languages)}
    words = {w: i for i, w in enumerate(sorted({r[1] for r in word_rows}))}
    grams = {g: i + len(words) for i, g in enumerate(sorted({r[1] for r in gram_rows}))}
    counts = np.zeros((len(words) + len(grams), len(languages)))
    for lang, word, n in word_rows:
        counts[words[word], place[lang]] += n
    for lang, gram, n in gram_rows:
        counts[grams[gram], place[lang]] += n
    logs = np.zeros_like(counts, dtype=np.float32)
    kinds = [np.arange(len(words))]
    kinds += [np.array([i for g, i in grams.items() if len(g) == n], int) for n in range(1, LONGEST + 1)]
    for rows in kinds:  # words, and the n-grams of each length, are a distribution each
        if len(rows) and languages:
            own = counts[rows] + 0.5
            logs[rows] = np.log(own / own.sum(axis=0))
    return Model(languages, words, grams, logs)


class Scorer:
    """Log likelihoods of words by language; unseen words are remembered up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        known = len(self.model.words)
        self.place = dict(self.model.words)
        self.logs = np.zeros((known + KNOWN_WORDS, len(self.model.languages)), np.float32)
        self.logs[:known] = self.model.logs[:known]

    def _backoff(self, word: str) -> np.ndarray:
        """Mean over the known n-grams of the greatest length of which any is known."""
        text = f" {word} "
        for n in range(min(LONGEST, len(text)), 0, -1):
            known = [i for i in map(self.model.grams.get, (text[k : k + n] for k in range(len(text) - n + 1))) if i is not None]
            if known:
                return self.model.logs[known].mean(axis=0)
        return np.zeros(len(self.model.languages), np.float32)

    def places(self, words: list[str]) -> np.ndarray:
        new = [w for w in set(words) if w not in self.place]
        if len(self.place) + len(new) > len(self.logs):
            self._forget()
            new = [w for w in set(words) if w not in self.place]
            if len(self.place) + len(new) > len(self.logs):  # a single text with more words than are remembered
                self.logs = np.concatenate([self.logs, np.zeros((len(new), self.logs.shape[1]), np.float32)])
        for w in new:
            at = self.place[w] = len(self.place)
            self.logs[at] = self._backoff(w)
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def predict(self, words: list[str]) -> tuple[str, float]:
        if not words or not self.model.languages:
            return UNKNOWN, 0.0
        at = self.places(words)
        total = self.logs[at].sum(axis=0, dtype=np.float64)
        shown = total * (min(len(words), EVIDENCE_WORDS) / len(words))
        weight = np.exp(shown - shown.max())
        best = int(np.argmax(total))
        return self.model.languages[best], float(weight[best] / weight.sum())


def predict_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    import regex

    letters = regex.compile(r"\p{L}+")
    scorer = Scorer(model)
    for batch in batches:
        found = [scorer.predict(letters.findall((t or "").lower())) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
            names=["doc_id", "lang_pred", "score"],
        )


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of each row. ``und`` and 0 for texts that are null, empty or without a letter, or if
    nothing was learned; ties go to the language that sorts first. Repeated rows are kept, other columns not read."""
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        return predict_batches(batches, shared.value)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double")
