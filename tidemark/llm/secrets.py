"""Find secrets in texts: three base patterns, and runs that character models take for random strings.

Built-in functions only. The model is two character Markov models, of random strings and of ordinary
identifiers; a run of identifier characters is a secret if its log-likelihood ratio is high enough.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, ready
from tidemark.llm.spans import by_start, count_kind, match_spans, overlaps, span_list

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run that is too short for its kind is dropped whole, so that the least length may stand in the pattern;
#: the lookbehind only spares tries in the middle of a run.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "(?<![0-9a-f])[0-9a-f]{24,}"
LEAST_ASSIGNED = 6

#: Runs the models judge, and what they are made of.
RUN_CLASS = "A-Za-z0-9+/_.=-"
LEAST_RUN = 20
RUN = f"(?<![{RUN_CLASS}])[{RUN_CLASS}]{{{LEAST_RUN},}}"
#: Nats for each character by which random must be likelier than ordinary.
THRESHOLD = 0.5
#: What a random string of that length has at least: kinds of characters (small, capital, digit) and different characters.
LEAST_KINDS = 2
LEAST_DIFFERENT = 10
LETTERS = 96  # ASCII 32 to 127
SMOOTHING = 0.01


@dataclass(frozen=True)
class Models:
    """``ratio[a * 96 + b]``: log of P(b after a) as random over P(b after a) as ordinary; ``known`` if both had samples."""

    ratio: tuple[float, ...]
    known: bool


def base_spans(text: Column) -> Column:
    assigned = F.filter(match_spans(text, ASSIGN, "assign", 0, group=2), lambda x: F.length(x["value"]) >= LEAST_ASSIGNED)
    return F.concat(assigned, match_spans(text, ACCESS, "access", 1), match_spans(text, HEX, "hex", 2))


def train(docs: DataFrame) -> Models:
    """Count character pairs of labelled samples in all documents.

    Random samples are the values that the base patterns find; ordinary ones are the shorter runs, which are never
    judged, of documents without a base span. Tasks add up their own counts first: at most 2 * 96 * 96 a task are
    shuffled, and as many come to the driver.
    """
    runs = F.regexp_extract_all("text", F.lit(f"(?<![{RUN_CLASS}])[{RUN_CLASS}]{{6,{LEAST_RUN - 1}}}(?![{RUN_CLASS}])"), F.lit(0))
    based = docs.select("text", F.transform(base_spans(F.col("text")), lambda x: x["value"]).alias("base"))
    labelled = based.select(
        (F.size("base") > 0).alias("random"), F.explode(F.when(F.size("base") > 0, F.col("base")).otherwise(runs)).alias("run")
    )
    pairs = (
        labelled.select("random", F.explode(F.regexp_extract_all("run", F.lit("(?=(..))."), F.lit(1))).alias("pair"))
        .groupBy("random", "pair")
        .count()
        .collect()
    )
    return models({(bool(r.random), ord(r.pair[0]), ord(r.pair[1])): r["count"] for r in pairs})


def models(pairs: dict[tuple[bool, int, int], int]) -> Models:
    """Smoothed transition models from counts by (random, code, next code)."""
    logs = {}
    for kind in (True, False):
        table = [[SMOOTHING] * LETTERS for _ in range(LETTERS)]
        for (random, a, b), n in pairs.items():
            if random == kind:
                table[a - 32][b - 32] += n
        # A character that was seen little backs off to the frequency of the next one.
        column = [sum(row[b] for row in table) for b in range(LETTERS)]
        total = sum(column)
        logs[kind] = [
            [math.log((row[b] + 10 * column[b] / total) / (sum(row) + 10)) for b in range(LETTERS)] for row in table
        ]
    ratio = tuple(logs[True][a][b] - logs[False][a][b] for a in range(LETTERS) for b in range(LETTERS))
    return Models(ratio, {k for k, _, _ in pairs} == {True, False})


def mean_ratio(run: Column, model: Models) -> Column:
    """Log-likelihood ratio of a run, by its number of character pairs."""
    table = F.lit(list(model.ratio))

    def total(code: Column) -> Column:
        pairs = F.zip_with(F.slice(code, 1, F.size(code) - 1), F.slice(code, 2, F.size(code) - 1), lambda a, b: a * LETTERS + b + 1)
        return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + F.element_at(table, x)) / F.greatest(F.size(pairs), F.lit(1))

    return let(F.transform(F.split(run, ""), lambda c: F.ascii(c) - 32), total)


def varied(run: Column) -> Column:
    """False for rules of dashes or dots, enumerations of letters and other runs that no generator makes, whatever the models say."""
    kinds = sum((run.rlike(f"[{x}]").cast("int") for x in ("a-z", "A-Z", "0-9")), F.lit(0))
    return (kinds >= LEAST_KINDS) & (F.size(F.array_distinct(F.split(run, ""))) >= LEAST_DIFFERENT)


def find_secrets(docs: DataFrame, model: Models | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (kind, rank, start, end, match, value) by start, then kind.

    Places are code points of the original text, ends exclusive. ``spans`` has the base spans and the runs of
    kind ``random``, varied enough and likelier random than ordinary, which overlap none of them. A null or empty text has no span; repeated rows are judged
    each; if no random or no ordinary sample is found, only the base patterns speak. Other columns pass through.
    """
    ready(docs.sparkSession)
    if model is None:
        model = train(docs)
    text = F.col("text")
    runs = match_spans(text, RUN, "random", 3)

    def judged(base: Column) -> Column:
        if not model.known:
            return base
        extra = F.filter(runs, lambda x: ~overlaps(x, base))
        return F.concat(base, F.filter(extra, lambda x: varied(x["value"]) & (mean_ratio(x["value"], model) >= threshold)))

    both = let(base_spans(text), lambda base: F.struct(by_start(base).alias("base"), by_start(judged(base)).alias("spans")))
    return docs.drop("base", "spans").withColumn("_found", both).select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in ("base", "spans")], "_found.base", "_found.spans"
    )


def digest(found: DataFrame) -> DataFrame:
    """doc_id, a count of each base kind, the hash of the base spans and all spans."""
    return found.select(
        "doc_id",
        *[count_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(span_list(F.col("base")), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )
