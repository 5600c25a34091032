"""Hypothesis tests and regressions from distributed sufficient statistics.

Each test first reduces the rows to a few numbers per group (or to counts of distinct values for the
rank tests). Only these small tables are paired and passed to the tail-probability functions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import replace
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import cleaning as c
from tidemark.functions import special as s
from tidemark.operators.descriptive import in_top_categories, top_categories
from tidemark.operators.distribution import (
    COUNT, COUNTS_PER_BUCKET, FEW_COUNTS, MEAN, Counted, count_values, mid_ranks, quantiles, summarise,
)
from tidemark.operators.sampling import sample_per_group
from tidemark.operators.small import attach, localize

ALPHA = 0.05
#: Groups of which all pairs are compared at most: two million pairs.
MAX_GROUPS = 2000


def moments(df: DataFrame, group: str, col: str = "price", min_n: int = 1) -> DataFrame:
    """n, mean and sample variance by group, as a local table when there are few groups."""
    out = df.where(F.col(col).isNotNull() & F.col(group).isNotNull()).groupBy(group).agg(
        F.count(col).alias("n"), F.avg(col).alias("mean"), F.var_samp(col).alias("var")
    )
    return localize(out.where(F.col("n") >= min_n))


def pairs(summary: DataFrame, group: str) -> DataFrame:
    """Every unordered pair of rows of a group summary, columns suffixed _a and _b; more than MAX_GROUPS are an error."""
    check_groups(summary)
    a = summary.select(*[F.col(x).alias(f"{x}_a") for x in summary.columns])
    b = summary.select(*[F.col(x).alias(f"{x}_b") for x in summary.columns])
    return a.join(b, F.col(f"{group}_a") < F.col(f"{group}_b"))


def check_groups(summary: DataFrame) -> None:
    """Pairwise tests grow with the square of the number of groups: refuse before any pair is made."""
    if summary.limit(MAX_GROUPS + 1).count() > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups: compare fewer, or the most frequent ones")


def _over_all() -> Window:
    return Window.partitionBy()


def shapiro(df: DataFrame, group: str = "source", col: str = "price", max_n: int = 5000,
            key: list[str] | None = None, alpha: float = ALPHA, seed: int = 42) -> DataFrame:
    """Shapiro-Wilk on a seeded sample of at most ``max_n`` rows per group."""
    rows = df.where(F.col(col).isNotNull() & F.col(group).isNotNull())
    keys = key or ["product_id", "scraped_at", col]
    drawn = sample_per_group(rows.select(group, col, *[k for k in keys if k not in (group, col)]), group, keys, max_n, seed)

    def test(labels: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        w, p = s.shapiro_wilk(pdf[col].to_numpy())
        return pd.DataFrame({group: [labels[0]], "w": [w], "p_value": [p]})

    tested = drawn.groupBy(group).applyInPandas(
        test, T.StructType([df.schema[group], T.StructField("w", T.DoubleType()), T.StructField("p_value", T.DoubleType())])
    )
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return sizes.join(tested, group).select(
        group, "n", F.round("w", 4).alias("w"), F.round("p_value", 6).alias("p_value"),
        c.normal_verdict("p_value", alpha).alias("normal"),
    )


def anova(df: DataFrame, group: str = "source", col: str = "price", min_n: int = 1) -> DataFrame:
    """One-way analysis of variance: F, p and eta squared."""
    m = moments(df, group, col, min_n)
    total = F.sum("n").over(_over_all())
    grand = F.sum(F.col("n") * F.col("mean")).over(_over_all()) / total
    parts = m.select("n", (F.col("n") * F.pow(F.col("mean") - grand, F.lit(2))).alias("ssb"),
                     (F.coalesce("var", F.lit(0.0)) * (F.col("n") - 1)).alias("ssw"))
    sums = parts.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"),
                     F.sum("ssb").alias("ssb"), F.sum("ssw").alias("ssw"))
    d1, d2 = F.col("k") - 1, F.col("n") - F.col("k")
    f = F.try_divide(F.col("ssb") / d1, F.col("ssw") / d2)
    return sums.select(
        "k", "n", F.round(f, 4).alias("f_stat"), s.f_p(f, d1, d2).alias("p_value"),
        F.round(F.try_divide(F.col("ssb"), F.col("ssb") + F.col("ssw")), 4).alias("eta_sq"),
    )


def levene(df: DataFrame, group: str = "source", col: str = "price") -> DataFrame:
    """Equality of variances around the group medians."""
    medians = quantiles(df, [group], col, {"_median": 0.5})
    away = attach(df.select(group, col), medians, [group]).select(
        group, F.abs(F.col(col) - F.col("_median")).alias("away")
    )
    return anova(away, group, "away").select("k", "n", "f_stat", "p_value")


def welch_t(df: DataFrame, group: str = "source", col: str = "price", alpha: float = ALPHA) -> DataFrame:
    """Pairwise comparison of means with unequal variances."""
    p = pairs(moments(df, group, col, 2), group)
    va, vb = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    diff = F.col("mean_a") - F.col("mean_b")
    t = F.try_divide(diff, F.sqrt(va + vb))
    freedom = F.try_divide((va + vb) * (va + vb), va * va / (F.col("n_a") - 1) + vb * vb / (F.col("n_b") - 1))
    out = p.withColumn("_p", s.t_p(t, freedom)).select(
        f"{group}_a", f"{group}_b",
        F.round("mean_a", 2).alias("mean_a"), F.round("mean_b", 2).alias("mean_b"),
        F.round(diff, 2).alias("mean_diff"), F.round(t, 4).alias("t_stat"),
        F.round("_p", 6).alias("p_value"), c.significant("_p", alpha).alias("significant"),
    )
    return out.orderBy("p_value", f"{group}_a", f"{group}_b")


#: Cells (distinct values by groups) that are held as a dense block while the counts of a bucket are paired.
BLOCK_CELLS = 2_000_000
PAIR_SUMS = "a int, b int, u double, ties double"


def pair_sums(counted: Counted, groups: list, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """(a, b, u, ties) for every pair of group numbers a < b, all from one pass over the table of value counts.

    ``u`` counts rows of ``b`` below rows of ``a``, ties as one half; ``ties`` is the sum of t^3 - t over the values of
    both. Buckets of values are sorted and paired on their own: a task adds the matrices of its buckets and gives one
    row a pair, and these are combined before they are shuffled. Nothing is looped over on the driver.
    """
    spark, group = counted.table.sparkSession, counted.by[0]
    k, offsets = len(groups), counted.offsets(group)
    before = np.array([offsets.get(g, [0] * (len(counted.cuts) + 1)) for g in groups], float).reshape(k, -1) if offsets else np.zeros((k, 1))
    kind = T.StructType([T.StructField(group, counted.table.schema[group].dataType), T.StructField("_no", T.IntegerType())])
    numbers = spark.createDataFrame([(g, n) for n, g in enumerate(groups)], kind)
    rows = attach(counted.bucketed(), numbers, [group], "inner").select("bucket", "_no", F.col(counted.col).cast("double").alias("v"), F.col("n").cast("double").alias("n"))
    sums = rows.repartition("bucket").sortWithinPartitions("bucket", "v").mapInArrow(lambda b: _pair_batches(b, before, block_cells), PAIR_SUMS)
    return sums.groupBy("a", "b").agg(F.sum("u").alias("u"), F.sum("ties").alias("ties"))


def _pair_batches(batches: Iterator[pa.RecordBatch], before: np.ndarray, block_cells: int) -> Iterator[pa.RecordBatch]:
    """The rows of PAIR_SUMS of a task, from rows (bucket, group number, value, n) sorted by bucket and value.

    ``before`` are the rows of each group before each bucket. A bucket holds a bounded number of counts.
    """
    k = len(before)
    u, cross, own = np.zeros((k, k)), np.zeros((k, k)), np.zeros(k)
    any_row = False

    def add(bucket: int, group: np.ndarray, value: np.ndarray, n: np.ndarray) -> None:
        below = before[:, bucket].copy()
        _, place = np.unique(value, return_inverse=True)
        step = max(1, block_cells // k)
        for first in range(0, int(place[-1]) + 1, step):
            lo, hi = np.searchsorted(place, [first, first + step])
            g, at, m = group[lo:hi], place[lo:hi] - first, n[lo:hi]
            dense = np.zeros((at[-1] + 1, k))
            dense[at, g] = m
            ahead = below + np.cumsum(dense, axis=0) - dense / 2
            below += dense.sum(axis=0)
            own[:] += np.bincount(g, m**3 - m, k)
            # Only the values that a group has are multiplied with all groups.
            for x in np.unique(g):
                mine = g == x
                u[x] += m[mine] @ ahead[at[mine]]
                cross[x] += 3 * (m[mine] ** 2 @ dense[at[mine]] + m[mine] @ dense[at[mine]] ** 2)

    now, held = None, []
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        cuts = np.flatnonzero(columns[0][1:] != columns[0][:-1]) + 1
        for part in zip(*(np.split(c, cuts) for c in columns), strict=True):
            if not len(part[0]):
                continue
            if now is not None and part[0][0] != now:
                add(now, *(np.concatenate(c) for c in zip(*held, strict=True)))
                held = []
            now, any_row = int(part[0][0]), True
            held.append(part[1:])
    if held:
        add(now, *(np.concatenate(c) for c in zip(*held, strict=True)))
    if any_row:
        a, b = np.triu_indices(k, 1)
        columns = [a.astype(np.int32), b.astype(np.int32), u[a, b], own[a] + own[b] + cross[a, b]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "u", "ties"])


def mann_whitney(
    df: DataFrame, group: str = "source", col: str = "price", alpha: float = ALPHA, min_n: int = 1,
    few: int = FEW_COUNTS, per_bucket: int = COUNTS_PER_BUCKET,
) -> DataFrame:
    """Pairwise rank test, two-sided. U counts, for the first group, the rows of the second below its
    own, ties as one half. Exact law where one group has at most 8 rows and nothing is tied."""
    rows = df.where(F.col(col).isNotNull() & F.col(group).isNotNull())
    counted = count_values(rows, [group], col, few, per_bucket)
    sizes = counted.table.groupBy(group).agg(F.sum("n").alias("n")).where(F.col("n") >= min_n)
    sizes = localize(sizes.join(counted.quantiles({"median": 0.5}), group))
    check_groups(sizes)
    groups = sorted(r[0] for r in sizes.select(group).collect())
    kind = T.StructType([T.StructField(group, df.schema[group].dataType), T.StructField("_no", T.IntegerType())])
    numbers = df.sparkSession.createDataFrame([(g, n) for n, g in enumerate(groups)], kind)
    # At most MAX_GROUPS rows on either side; the pairs are joined by their numbers.
    numbered = pairs(sizes.join(F.broadcast(numbers), group), group)
    p = numbered.join(pair_sums(counted, groups), (F.col("_no_a") == F.col("a")) & (F.col("_no_b") == F.col("b")))
    n1, n2 = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    n = n1 + n2
    spread = F.sqrt(n1 * n2 / 12 * (n + 1 - F.col("ties") / (n * (n - 1))))
    z = F.try_divide(F.greatest(F.col("u"), n1 * n2 - F.col("u")) - n1 * n2 / 2 - 0.5, spread)
    small = ((n1 <= 8) | (n2 <= 8)) & (F.col("ties") == 0)
    # The exact law is only evaluated for the pairs that need it.
    near = F.least(F.lit(1.0), s.norm_p(F.greatest(z, F.lit(0.0))))
    exact = s.u_exact_p(F.when(small, F.col("u")), n1, n2)
    scored = p.withColumn("_small", small).withColumn("_near", near).withColumn("_exact", exact)
    scored = scored.withColumn("_p", F.when(F.col("_small"), F.col("_exact")).otherwise(F.col("_near")))
    effect = 1 - 2 * F.col("u") / (n1 * n2)
    return scored.select(
        f"{group}_a", f"{group}_b",
        F.round("median_a", 2).alias("median_a"), F.round("median_b", 2).alias("median_b"),
        F.round("u", 0).alias("u_stat"), F.round("_p", 6).alias("p_value"),
        F.round(effect, 3).alias("effect_r"), c.significant("_p", alpha).alias("significant"),
    ).orderBy("p_value", f"{group}_a", f"{group}_b")


def p_value_matrix(tests: DataFrame, group: str = "source") -> DataFrame:
    """Symmetric matrix of log10(p + 1e-10) in long form, with p = 1 on the diagonal."""
    tests = localize(tests)
    a, b = F.col(f"{group}_a"), F.col(f"{group}_b")
    one_way = tests.select(a.alias("row"), b.alias("col"), "p_value")
    other = tests.select(b.alias("row"), a.alias("col"), "p_value")
    labels = one_way.select("row").union(other.select("row")).distinct()
    same = labels.select("row", F.col("row").alias("col"), F.lit(1.0).alias("p_value"))
    return one_way.unionByName(other).unionByName(same).withColumn(
        "log10_p", F.round(F.log10(F.col("p_value") + 1e-10), 4)
    )


def matrix_wide(matrix: DataFrame) -> DataFrame:
    """The matrix with one column per group; ``descriptive.wide_blocks`` takes more groups than a pivot."""
    return matrix.groupBy("row").pivot("col").agg(F.first("log10_p"))


def kruskal(
    df: DataFrame, group: str = "source", col: str = "price", min_n: int = 1,
    few: int = FEW_COUNTS, per_bucket: int = COUNTS_PER_BUCKET,
) -> DataFrame:
    """Rank-based analysis of variance with tie correction: H, p and epsilon squared."""
    rows = df.where(F.col(col).isNotNull() & F.col(group).isNotNull())
    counted = count_values(rows, [group], col, few, per_bucket)
    if min_n > 1:
        kept = counted.table.groupBy(group).agg(F.sum("n").alias("_n")).where(F.col("_n") >= min_n).select(group)
        counted = replace(counted, table=attach(counted.table, kept, [group], how="inner"))
    ranks = mid_ranks(counted)
    ties = F.col("ties").cast("double")
    sums = localize(
        ranks.groupBy(group).agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.col("rank")).alias("r"),
            F.sum(F.col("n") * (ties * ties - 1)).alias("t"),
        )
    )
    total = F.sum("n").over(_over_all()).cast("double")
    spread = F.col("n") * F.pow(F.col("r") / F.col("n") - (total + 1) / 2, F.lit(2))
    out = sums.select("n", "t", spread.alias("spread")).agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("t").alias("t"), F.sum("spread").alias("s")
    )
    n = F.col("n").cast("double")
    h = F.try_divide(12 / (n * (n + 1)) * F.col("s"), 1 - F.col("t") / (n * n * n - n))
    return out.select(
        "k", "n", F.round(h, 4).alias("h_stat"), s.chi2_p(h, F.col("k") - 1).alias("p_value"),
        F.round((h - F.col("k") + 1) / (n - F.col("k")), 4).alias("epsilon_sq"),
    )


def category_anova(df: DataFrame, k: int = 8, min_n: int = 5) -> DataFrame:
    """Means of the ``k`` most frequent categories compared."""
    return anova(in_top_categories(df, k), "category", "price", min_n)


def category_kruskal(df: DataFrame, k: int = 8, min_n: int = 5) -> DataFrame:
    return kruskal(in_top_categories(df, k), "category", "price", min_n)


def category_means(df: DataFrame, k: int = 8, min_n: int = 5) -> DataFrame:
    table = summarise(in_top_categories(df, k), ["category"], "price", {"n": COUNT, "mean": MEAN}, {"median": 0.5})
    return (
        table.where(F.col("n") >= min_n)
        .select("category", "n", F.round("mean", 2).alias("mean"), F.round("median", 2).alias("median"))
        .orderBy(F.desc("median"), "category")
    )


def confidence_interval(df: DataFrame, group: str = "source", level: float = 0.95, min_n: int = 2) -> DataFrame:
    """Mean and its two-sided interval by group."""
    m = moments(df, group, "price", min_n)
    se = F.sqrt(F.col("var") / F.col("n"))
    reach = s.t_ppf(F.lit((1 + level) / 2), F.col("n") - 1)
    with_q = m.withColumn("_se", se).withColumn("_q", reach)
    half = F.col("_q") * F.col("_se")
    return with_q.select(
        group, "n", F.round("mean", 2).alias("mean"), F.round("_se", 3).alias("se"),
        F.round(F.col("mean") - half, 2).alias("ci_lower"), F.round(F.col("mean") + half, 2).alias("ci_upper"),
        F.round(2 * half, 2).alias("ci_width"),
    )


def linregress(df: DataFrame, y: str, x: str, group: str | None = None, min_n: int = 10, alpha: float = ALPHA) -> DataFrame:
    """Simple regression of ``y`` on ``x``, by group or pooled."""
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    by = [group] if group else []
    fits = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope(y, x).alias("b"), F.regr_intercept(y, x).alias("a"),
        F.corr(y, x).alias("r"), F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"),
    )
    fits = localize(fits.where(F.col("n") >= min_n))
    left = 1 - F.col("r") * F.col("r")
    freedom = F.col("n") - 2
    t = F.try_divide(F.col("r") * F.sqrt(freedom), F.sqrt(left))
    se = F.sqrt(F.try_divide(left * F.col("syy"), F.col("sxx") * freedom))
    p = F.coalesce(s.t_p(t, freedom), F.when(F.col("r").isNotNull() & (left <= 0), 0.0))
    scored = fits.withColumn("_p", p).withColumn("_se", se)
    return scored.select(
        *by, "n", F.round("b", 4).alias("slope"), F.round("a", 2).alias("intercept"), F.round("r", 4).alias("r"),
        F.round(F.col("r") * F.col("r"), 4).alias("r2"), F.round("_p", 6).alias("p_value"),
        F.round("_se", 4).alias("se"), c.significant("_p", alpha).alias("significant"),
    )


def with_days(df: DataFrame) -> DataFrame:
    """Days since the earliest observation of the whole relation."""
    start = df.agg(F.min("scraped_at").alias("start"))
    return df.withColumn("days_since_start", c.days_between(start.scalar(), "scraped_at"))


def trend(df: DataFrame, group: str = "source", min_n: int = 10) -> DataFrame:
    """Price against time by group."""
    fits = linregress(with_days(df), "price", "days_since_start", group, min_n)
    return fits.select(
        group, F.col("slope").alias("slope_per_day"), "r2", "p_value", c.trend_label("slope").alias("trend")
    )


def ols(df: DataFrame, y: str, xs: list[str]) -> DataFrame:
    """Multiple regression: one row per term with its error, t and p, and the fit of the model.

    One pass yields means and covariances; solving the (few x few) system is left to the driver.
    """
    rows = df.where(c.all_of([F.col(x).isNotNull() for x in [y, *xs]]))
    names = [*xs, y]
    aggs: list[Column] = [F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(f"m_{i}") for i, v in enumerate(names)]]
    aggs += [
        F.covar_samp(names[i], names[j]).alias(f"c_{i}_{j}") for i in range(len(names)) for j in range(i, len(names))
    ]
    row = rows.agg(*aggs).first()
    n, k = row["n"], len(xs)
    cov = np.array([[row[f"c_{min(i, j)}_{max(i, j)}"] for j in range(k + 1)] for i in range(k + 1)], dtype=float)
    mean = np.array([row[f"m_{i}"] for i in range(k + 1)], dtype=float)
    inverse = np.linalg.inv(cov[:k, :k])
    beta = inverse @ cov[:k, k]
    explained = float(beta @ cov[:k, k])
    freedom = n - k - 1
    residual = (n - 1) * (cov[k, k] - explained) / freedom
    spread = residual * inverse / (n - 1)
    coef = [mean[k] - float(beta @ mean[:k]), *beta]
    errors = [math.sqrt(residual / n + float(mean[:k] @ spread @ mean[:k])), *np.sqrt(np.diag(spread))]
    r2 = explained / cov[k, k]
    adjusted = 1 - (1 - r2) * (n - 1) / freedom
    out = [
        (term, float(b), float(e), float(b / e), s.t_two_sided(float(b / e), freedom), float(r2), float(adjusted), n)
        for term, b, e in zip(["Intercept", *xs], coef, errors)
    ]
    table = df.sparkSession.createDataFrame(
        out, "term string, coef double, se double, t double, p_value double, r2 double, r2_adj double, n long"
    )
    rounding = {"coef": 6, "se": 6, "t": 3, "p_value": 6, "r2": 6, "r2_adj": 6}
    return table.select(*[F.round(x, rounding[x]).alias(x) if x in rounding else F.col(x) for x in table.columns])


def log_price_model(df: DataFrame) -> DataFrame:
    """log(price) on rating and days since start."""
    rows = with_days(df).withColumn("log_price", F.log("price"))
    return ols(rows, "log_price", ["rating", "days_since_start"])


def required_n(d: float = 0.5, alpha: float = ALPHA, power: float = 0.8) -> int:
    z = NormalDist().inv_cdf
    return math.ceil(2 * ((z(1 - alpha / 2) + z(power)) / d) ** 2)


def power_adequacy(df: DataFrame, group: str = "source", d: float = 0.5, alpha: float = ALPHA, power: float = 0.8) -> DataFrame:
    """Rows by group against the number needed to detect an effect of size ``d``."""
    need = required_n(d, alpha, power)
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).select(
        group, "n", F.lit(need).alias("required_n"),
        F.when(F.col("n") >= need, "OK").otherwise("UNDERPOWERED").alias("adequacy"),
    )


def cohens_d(df: DataFrame, group: str = "source", col: str = "price") -> DataFrame:
    """Standardised mean difference of every pair, largest first."""
    p = pairs(moments(df, group, col), group)
    pooled = F.sqrt((F.col("var_a") + F.col("var_b")) / 2)
    d = F.when(pooled > 0, (F.col("mean_a") - F.col("mean_b")) / pooled).otherwise(0.0)
    return (
        p.withColumn("_d", d)
        .select(f"{group}_a", f"{group}_b", F.round("_d", 3).alias("cohen_d"), c.effect_label("_d").alias("magnitude"))
        .orderBy(F.desc(F.abs("cohen_d")), f"{group}_a", f"{group}_b")
    )


__all__ = [
    "anova", "category_anova", "category_kruskal", "category_means", "cohens_d", "confidence_interval", "kruskal", "levene", "linregress",
    "log_price_model", "mann_whitney", "matrix_wide", "moments", "ols", "p_value_matrix", "pairs",
    "power_adequacy", "required_n", "shapiro", "top_categories", "trend", "welch_t", "with_days",
]
