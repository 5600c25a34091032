"""Mix sources to target weights: repetition rates from token totals, whole copies plus one Bernoulli copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.llm.common import WORD, unit_hash, written

#: Sources in code point order weigh these in turn, again and again.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
SEED = 9


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target): ``share`` of all sizes dealt to the sources by weight, none above ``most`` times its size.

    A source that would be above gets its bound, and the excess goes to the others by weight until none is
    above. With sources in the order of bound by weight, the first k are at their bound, where k is the
    largest number for which the rest, dealt by weight, still exceeds the k-th bound; so one running sum
    replaces the rounds. The window is over one row per source. Needs share <= most.
    """
    totals = written(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    named = totals.withColumn("_weight", weight).withColumn("_bound", most * F.col("source_size").cast("double"))
    by_level = Window.orderBy(F.col("_bound") / F.col("_weight"), F.col("source").asc_nulls_last())
    upto = by_level.rowsBetween(Window.unboundedPreceding, -1)
    since = by_level.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = (
        share * F.sum("source_size").over(every).cast("double") - F.coalesce(F.sum("_bound").over(upto), F.lit(0.0))
    ) / F.sum("_weight").over(since)
    return (
        named.withColumn("_level", level)
        .withColumn("_free", F.col("_level") * F.col("_weight") <= F.col("_bound"))
        .withColumn("_line", F.max(F.when(F.col("_free"), F.col("_level"))).over(every))
        .select(
            "source",
            "source_size",
            F.when(F.col("_free"), F.least(F.col("_line") * F.col("_weight"), F.col("_bound"))).otherwise(F.col("_bound")).alias("target"),
        )
    )


def mix(docs: DataFrame, seed: int = SEED, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``docs`` with size, source_size, target and copies.

    ``copies`` is floor(rate) plus one if a hash of seed and doc_id, as a number in [0, 1), is below the rest of
    the rate; rate is the source's target by its size. A null text has size 0, a null source is a source that
    comes last, rows of one doc_id get the same hash, rows without one that of their text, and a source without words has
    rate 0. An empty table
    gives no rows. Other columns pass through; columns named like the new ones are replaced.
    """
    docs = docs.drop("size", "source_size", "target", "copies")
    sized = docs.withColumn("size", n_words())
    targets = source_targets(sized.select("source", "size"), weights, share, most)
    name = F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))
    known = targets.select(name.alias("_source"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    drawn_by = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce("text", F.lit("")))))
    more = (unit_hash(seed, drawn_by) < F.col("_rate") - F.floor("_rate")).cast("long")
    return (
        sized.withColumn("_source", name)
        .join(known, "_source", "left")
        .withColumn("_rate", rate)
        .withColumn("copies", F.floor("_rate") + more)
        .drop("_source", "_rate")
    )


def emit_copies(mixed: DataFrame) -> DataFrame:
    """Each row as often as ``copies`` says, with the number of the copy in ``copy`` (from 1)."""
    return mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
