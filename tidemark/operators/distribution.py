"""Exact quantiles and ranks without an unbounded sort in one task.

The rows are read once and reduced to counts of distinct values, which are written to the shared folder.
All else works on these counts. When there are few of them, the built-in ``percentile`` or one window is
enough. Otherwise the value range is cut into buckets with about the same number of distinct values;
only bucket totals travel to the driver, and each bucket is sorted by itself. A value that a third of
all rows share is one counted row, so it cannot make a bucket large. Buckets serve the groups that need them:
a group of few counts is one row of ``percentile``, however many such groups there are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.cleaning import any_of
from tidemark.operators.small import attach, collect_small, localize
from tidemark.session import stash

FEW_COUNTS = 1_000_000
COUNTS_PER_BUCKET = 200_000
SMALL_GROUPS_PER_BUCKET = 10


def value_counts(df: DataFrame, by: list[str], col: str) -> DataFrame:
    """One row per distinct value and group: the counts are combined before the shuffle. NaN is no value."""
    return df.where(F.col(col).isNotNull() & ~F.isnan(col)).groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class Counted:
    """Counts ``(by..., col, n)`` in a written table."""

    table: DataFrame
    by: list[str]
    col: str
    few: int
    per_bucket: int

    @cached_property
    def size(self) -> int:
        return self.table.count()

    @cached_property
    def cuts(self) -> tuple[float, ...]:
        """Limits of the value buckets, empty if one bucket is enough."""
        if self.size <= self.few:
            return ()
        buckets = self.size // self.per_bucket + 2
        shares = [i / buckets for i in range(1, buckets)]
        cuts = self.table.agg(F.percentile_approx(self.col, shares, max(10_000, 10 * buckets))).first()[0]
        return tuple(sorted(set(cuts or [])))

    def bucketed(self, df: DataFrame | None = None) -> DataFrame:
        """Bucket number that grows with the value; the limits are literals, so reruns agree."""
        return into_buckets(self.table if df is None else df, self.col, self.cuts)

    def quantiles(self, probs: dict[str, float], by: list[str] | None = None) -> DataFrame:
        """Linearly interpolated quantiles by group, one column per entry of ``probs``."""
        by = self.by if by is None else by
        if not self.cuts:
            return _percentiles(self.table, by, self.col, probs)
        counts = self.table
        if by != self.by:
            counts = counts.groupBy(*by, self.col).agg(F.sum("n").alias("n"))
        most = min(self.few, self.per_bucket // SMALL_GROUPS_PER_BUCKET)
        if not by or not most:
            return _selected_quantiles(self.bucketed(counts), by, self.col, probs)
        large = localize(_large_groups(counts, by, most, self.size))
        keyed = counts.withColumn("_g", F.struct(*by))
        selected = _selected_quantiles(self.bucketed(keyed.join(large, "_g", "left_semi").drop("_g")), by, self.col, probs)
        return _percentiles(keyed.join(large, "_g", "left_anti"), by, self.col, probs).unionByName(selected)

    def offsets(self, by: str | None = None) -> dict:
        """Rows before each bucket, overall or for every value of ``by`` (at most buckets x groups)."""
        if not self.cuts:
            return {}
        keys = ["bucket"] if by is None else [by, "bucket"]
        groups: dict = {}
        for row in self.bucketed().groupBy(*keys).agg(F.sum("n").alias("n")).collect():
            groups.setdefault(row[by] if by else None, {})[row["bucket"]] = row["n"]
        size = len(self.cuts) + 1
        return {
            g: [0, *accumulate(totals.get(b, 0) for b in range(size))][:size] for g, totals in groups.items()
        }


def count_values(
    df: DataFrame, by: list[str], col: str, few: int = FEW_COUNTS, per_bucket: int = COUNTS_PER_BUCKET
) -> Counted:
    return Counted(stash(value_counts(df, by, col), "counts"), by, col, few, per_bucket)


def into_buckets(df: DataFrame, col: str, cuts: tuple[float, ...]) -> DataFrame:
    if not cuts:
        return df.withColumn("bucket", F.lit(0))
    splits = [float("-inf"), *cuts, float("inf")]
    marked = Bucketizer(splits=splits, inputCol=col, outputCol="bucket").transform(df)
    return marked.withColumn("bucket", F.col("bucket").cast("int"))


def quantiles(
    df: DataFrame, by: list[str], col: str, probs: dict[str, float], few: int = FEW_COUNTS,
    per_bucket: int = COUNTS_PER_BUCKET,
) -> DataFrame:
    return count_values(df, by, col, few, per_bucket).quantiles(probs)


#: What ``summarise`` can give, from the number of rows, the mean, the sums of powers of deviations and the bounds.
COUNT, MEAN, LOWEST, HIGHEST = "_n", "_mean", "_lo", "_hi"
VARIANCE = "_m2 / nullif(_n - 1, 0)"
STD = f"sqrt({VARIANCE})"
STD_POP = "sqrt(_m2 / nullif(_n, 0))"
SKEWNESS = "sqrt(_n) * _m3 / nullif(pow(_m2, 1.5), 0)"
KURTOSIS = "_n * _m4 / nullif(_m2 * _m2, 0) - 3"


def summarise(
    df: DataFrame, by: list[str], col: str, stats: dict[str, str], probs: dict[str, float], counted: Counted | None = None
) -> DataFrame:
    """Moments and exact quantiles by group, all from one pass over ``df``: the counts of its distinct values.

    ``stats`` gives expressions like STD by name of the result. Starts jobs: the counts are written, and the table
    of means, one row for each group, is joined back to them. A group without any value keeps a row.
    """
    groups = None
    if counted is None:
        value = F.when(~F.isnan(col), F.col(col))
        every = stash(df.groupBy(*by, value.alias(col)).agg(F.count(value).alias("n")), "counts")
        counted = Counted(every.where("n > 0"), by, col, FEW_COUNTS, COUNTS_PER_BUCKET)
        groups = every.groupBy(*by).agg(F.lit(1).alias("_one")).drop("_one")
    rows = counted.table.select(F.struct(*by).alias("_g"), F.col(col).alias("_v"), "n")
    means = rows.groupBy("_g").agg(
        F.sum("n").alias("_n"),
        (F.sum(F.col("_v") * F.col("n")) / F.sum("n")).alias("_mean"),
        F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi"),
    )
    powers = [k for k in (2, 3, 4) if any(f"_m{k}" in x for x in stats.values())]
    if powers:
        # Equal values deviate by nothing, whatever the rounding of their mean.
        away = F.when(F.col("_lo") == F.col("_hi"), 0.0).otherwise(F.col("_v") - F.col("_mean"))
        sums = [F.sum(F.pow(away, F.lit(float(k))) * F.col("n")).alias(f"_m{k}") for k in powers]
        first = [F.first(x).alias(x) for x in ("_n", "_mean", "_lo", "_hi")]
        means = attach(rows, means, ["_g"], "inner").groupBy("_g").agg(*first, *sums)
    found = localize(means.select("_g", *[F.expr(x).alias(name) for name, x in stats.items()]))
    plain = found.select(*[F.col(f"_g.{x}").alias(x) for x in by], *stats)
    if groups is not None:
        plain = _beside(groups, plain, by, list(stats))
        plain = plain.select(*by, *[F.coalesce(x, F.lit(0)).alias(x) if stats[x] == COUNT else F.col(x) for x in stats])
    return _beside(plain, localize(counted.quantiles(probs, by)), by, list(probs)) if probs else plain


def beside_quantiles(df: DataFrame, by: list[str], col: str, aggs: list[Column], probs: dict[str, float]) -> DataFrame:
    """Aggregates that need whole rows and exact quantiles side by side: two passes over ``df``, which is best written."""
    return _beside(df.groupBy(*by).agg(*aggs), localize(quantiles(df, by, col, probs)), by, list(probs))


def _beside(left: DataFrame, right: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """Columns ``names`` of a small summary beside the rows of another one; null labels meet."""
    renamed = right.select(*[F.col(x).alias(f"_{x}") for x in by], *names)
    same = [F.col(x).eqNullSafe(F.col(f"_{x}")) for x in by]
    return left.join(renamed, same, "left").select(*left.columns, *names)


def _percentiles(counts: DataFrame, by: list[str], col: str, probs: dict[str, float]) -> DataFrame:
    return counts.groupBy(*by).agg(*[F.percentile(col, F.lit(p), F.col("n")).alias(name) for name, p in probs.items()])


def _large_groups(counts: DataFrame, by: list[str], most: int, size: int) -> DataFrame:
    """Groups (``_g``) of more than ``most`` counts: ``size / most`` at the most.

    Counts are first added up in slots by a hash of the group, so that only groups of a crowded slot are counted one by one.
    """
    slot = F.pmod(F.xxhash64(*by), F.lit(4 * size // most + 1))
    crowded = localize(counts.groupBy(slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > most).select("_slot"))
    rows = counts.withColumn("_slot", slot).join(crowded, "_slot", "left_semi")
    return rows.groupBy(F.struct(*by).alias("_g")).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > most).select("_g")


def _selected_quantiles(counts: DataFrame, by: list[str], col: str, probs: dict[str, float]) -> DataFrame:
    """Find the buckets that hold the wanted ranks, then sort only those."""
    # As fields of a struct, null labels join like any other.
    key = F.struct(*by) if by else F.lit("")
    rows = counts.withColumn("_g", key)
    totals = rows.groupBy("_g", "bucket").agg(F.sum("n").alias("bn"))
    upto = Window.partitionBy("_g").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    spans = totals.withColumn("before", F.sum("bn").over(upto) - F.col("bn")).withColumn(
        "total", F.sum("bn").over(Window.partitionBy("_g"))
    )
    position = {name: F.lit(float(p)) * (F.col("total") - 1) for name, p in probs.items()}
    wanted = any_of(
        [
            (F.col("before") <= rank) & (rank < F.col("before") + F.col("bn"))
            for pos in position.values()
            for rank in (F.floor(pos), F.ceil(pos))
        ]
    )
    chosen = spans.where(wanted).select("_g", "bucket", "before", "total")
    # The counts of one group in one bucket are few, so a join by both needs no salt.
    few = collect_small(chosen)
    kept = rows.join(chosen if few is None else F.broadcast(few), ["_g", "bucket"])
    inside = Window.partitionBy("_g", "bucket").orderBy(col).rowsBetween(Window.unboundedPreceding, 0)
    placed = kept.withColumn("end", F.col("before") + F.sum("n").over(inside)).withColumn(
        "start", F.col("end") - F.col("n")
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("start") <= rank) & (rank < F.col("end")), F.col(col)))

    picks = []
    for name, pos in position.items():
        picks += [at(F.floor(pos)).alias(f"_lo_{name}"), at(F.ceil(pos)).alias(f"_hi_{name}")]
    found = placed.groupBy("_g", *by).agg(F.first("total").alias("total"), *picks)
    out = []
    for name, pos in position.items():
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        between = (F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi
        out.append(F.when(pos == F.floor(pos), lo).otherwise(between).alias(name))
    return found.select(*by, *out)


def offset_column(offsets: list[int] | None) -> Column:
    """Rows before the bucket of the current row."""
    if not offsets:
        return F.lit(0).cast("long")
    return F.element_at(F.array(*[F.lit(int(x)).cast("long") for x in offsets]), F.col("bucket") + 1)


def mid_ranks(counted: Counted) -> DataFrame:
    """(group, value, n, ties, rank) for counts by one group: ``rank`` is the mid-rank of the value over
    all groups and ``ties`` how many rows share it."""
    group, col = counted.by[0], counted.col
    upto = Window.partitionBy("bucket").orderBy(col).rangeBetween(Window.unboundedPreceding, 0)
    return (
        counted.bucketed()
        .withColumn("_end", F.sum("n").over(upto))
        .withColumn("ties", F.sum("n").over(Window.partitionBy("bucket", col)))
        .withColumn("rank", offset_column(counted.offsets().get(None)) + F.col("_end") - (F.col("ties") - 1) / 2)
        .select(group, col, "n", "ties", "rank")
    )
