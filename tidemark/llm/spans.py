"""Places of regular-expression matches, with built-in functions only.

Spark's functions return matches without their places. The texts between the matches come from ``split`` with
the same pattern, so places are running sums of lengths, in code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.llm.common import let

SPAN = "array<struct<kind:string,rank:int,start:int,end:int,match:string,value:string>>"


def _running(values: Column) -> Column:
    step = F.aggregate(
        values,
        F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("sums")),
        lambda acc, x: F.struct(
            (acc["total"] + x).alias("total"), F.concat(acc["sums"], F.array(acc["total"] + x)).alias("sums")
        ),
    )
    return step["sums"]


def running_sums(values: Column) -> Column:
    """Inclusive running sums of an array of ints.

    An array grows by copying, so sums are taken in blocks of about the square root of the size and then moved
    by the sums of the blocks before: n values cost n ** 1.5 instead of n ** 2 copies.
    """

    def blocked(v: Column) -> Column:
        width = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(v))).cast("int"))
        firsts = F.sequence(F.lit(1), F.greatest(F.size(v), F.lit(1)), width)
        blocks = F.transform(firsts, lambda first: _running(F.slice(v, first, width)))

        def moved(b: Column) -> Column:
            before = F.concat(F.array(F.lit(0)), _running(F.transform(b, lambda x: F.coalesce(F.try_element_at(x, F.lit(-1)), F.lit(0)))))
            return let(
                before,
                lambda base: F.flatten(F.transform(b, lambda x, i: F.transform(x, lambda y: y + F.element_at(base, i + 1)))),
            )

        return let(blocks, moved)

    return let(values, blocked)


def match_spans(text: Column, pattern: str, kind: str, rank: int, group: int = 0) -> Column:
    """All leftmost non-overlapping matches of a pattern that never matches the empty text.

    ``value`` is the given group. A null text has none.
    """
    rx = F.lit(pattern)

    def spans(found: Column) -> Column:
        values = F.regexp_extract_all(text, rx, F.lit(group)) if group else found
        lengths = F.transform(found, F.length)
        gaps = F.transform(F.split(text, pattern, -1), F.length)
        ends = running_sums(F.zip_with(F.slice(gaps, 1, F.size(found)), lengths, lambda gap, own: gap + own))
        return F.transform(
            F.arrays_zip(ends.alias("end"), found.alias("match"), values.alias("value")),
            lambda x: F.struct(
                F.lit(kind).alias("kind"),
                F.lit(rank).alias("rank"),
                (x["end"] - F.length(x["match"])).alias("start"),
                x["end"].alias("end"),
                x["match"].alias("match"),
                x["value"].alias("value"),
            ),
        )

    none = F.array().cast(SPAN)
    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, rx, F.lit(0)), spans)).otherwise(none)


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of the array."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def by_start(spans: Column) -> Column:
    return _ordered(spans, "start", "rank")


def by_kind(spans: Column) -> Column:
    return _ordered(spans, "rank", "start")


def _ordered(spans: Column, *first: str) -> Column:
    names = [*first, "end", *[n for n in ("kind", "rank", "start", "match", "value") if n not in first]]
    return F.array_sort(F.transform(spans, lambda x: F.struct(*[x[n].alias(n) for n in names])))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def overlaps(span: Column, spans: Column) -> Column:
    return F.exists(spans, lambda x: (x["start"] < span["end"]) & (x["end"] > span["start"]))
