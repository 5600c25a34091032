"""Descriptive statistics of prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cleaning as c
from tidemark.operators.distribution import (
    COUNT,
    HIGHEST,
    KURTOSIS,
    LOWEST,
    MEAN,
    SKEWNESS,
    STD,
    STD_POP,
    VARIANCE,
    count_values,
    quantiles,
    summarise,
)
from tidemark.operators.history import lag_price
from tidemark.operators.small import attach, collect_small, localize
from tidemark.session import stash

OVERALL = "★ OVERALL"
QUARTILES = {"q25": 0.25, "q75": 0.75}
MEDIAN = {"median": 0.5}


def _rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.select(*[F.round(x, digits[x]).alias(x) if x in digits else F.col(x) for x in df.columns])


def fallback_stats(df: DataFrame) -> DataFrame:
    """Statistics by source and currency over all rows; here every row counts as a product."""
    stats = {"product_count": COUNT, "avg_price": MEAN, "min_price": LOWEST, "max_price": HIGHEST, "stddev_price": STD}
    out = summarise(df, ["source", "currency"], "price", stats, {"median_price": 0.5})
    return _rounded(out, {x: 2 for x in out.columns if x.endswith("_price")})


def central_tendency(df: DataFrame, group: str = "source") -> DataFrame:
    """n, mean, median, mode (smallest on ties) and geometric mean by group and over everything.

    All of it follows from the counts of the distinct values; the overall row reuses them.
    """
    counted = count_values(df, [group], "price")
    overall = counted.table.groupBy("price").agg(F.sum("n").alias("n")).withColumn(group, F.lit(OVERALL))
    both = counted.table.unionByName(overall)
    n = F.sum("n")
    aggs = [
        n.alias("n"),
        (F.sum(F.col("price") * F.col("n")) / n).alias("mean"),
        F.max_by("price", F.struct(F.col("n"), -F.col("price"))).alias("mode"),
        F.exp(
            F.sum(F.when(F.col("price") > 0, F.log("price") * F.col("n")))
            / F.sum(F.when(F.col("price") > 0, F.col("n")))
        ).alias("geometric_mean"),
    ]
    medians = counted.quantiles(MEDIAN).unionByName(counted.quantiles(MEDIAN, []).withColumn(group, F.lit(OVERALL)))
    out = both.groupBy(group).agg(*aggs).join(localize(medians), group, "left")
    return _rounded(
        out.select(group, "n", "mean", "median", "mode", "geometric_mean"),
        {"mean": 2, "median": 2, "mode": 2, "geometric_mean": 2},
    )


def dispersion(df: DataFrame, group: str = "source") -> DataFrame:
    stats = {
        "std": STD,
        "variance": VARIANCE,
        "range_": f"{HIGHEST} - {LOWEST}",
        "cv_pct": f"{STD} / nullif({MEAN}, 0) * 100",
    }
    out = summarise(df, [group], "price", stats, QUARTILES).withColumn("iqr", F.col("q75") - F.col("q25"))
    return _rounded(
        out.select(group, "std", "variance", "q25", "q75", "iqr", "range_", "cv_pct"),
        {"std": 2, "variance": 2, "q25": 2, "q75": 2, "iqr": 2, "range_": 2, "cv_pct": 1},
    )


def shape(df: DataFrame, group: str = "source") -> DataFrame:
    """Population skewness and excess kurtosis."""
    return df.groupBy(group).agg(
        F.count("price").alias("n"),
        F.round(F.skewness("price"), 3).alias("skewness"),
        F.round(F.kurtosis("price"), 3).alias("kurtosis"),
    )


def category_summary(df: DataFrame, drop_null: bool = True) -> DataFrame:
    """Six metrics by category; rows without one are left out, or a group of their own."""
    df = df.where("category IS NOT NULL") if drop_null else df
    stats = {"n": COUNT, "mean": MEAN, "std": STD}
    out = summarise(df, ["category"], "price", stats, {**MEDIAN, **QUARTILES})
    return _rounded(
        out.select("category", "n", "mean", "median", "std", "q25", "q75"),
        {"mean": 2, "median": 2, "std": 2, "q25": 2, "q75": 2},
    ).orderBy(F.desc("median"), "category")


def full_summary(df: DataFrame, drop_null: bool = True) -> DataFrame:
    """Nine metrics by source and category; rows without either are left out, or groups of their own."""
    df = df.where("source IS NOT NULL AND category IS NOT NULL") if drop_null else df
    stats = {"count": COUNT, "mean": MEAN, "std": STD, "min": LOWEST, "max": HIGHEST, "skewness": SKEWNESS}
    out = summarise(df, ["source", "category"], "price", stats, {**MEDIAN, **QUARTILES})
    return _rounded(
        out.select("source", "category", "count", "mean", "median", "std", "min", "max", "q25", "q75", "skewness"),
        {"mean": 2, "median": 2, "std": 2, "q25": 2, "q75": 2, "skewness": 3},
    ).orderBy("source", F.desc("median"), "category")


def describe_prices(df: DataFrame, group: str = "source") -> DataFrame:
    """The dashboard's summary table."""
    stats = {"n": COUNT, "mean": MEAN, "std": STD, "min": LOWEST, "max": HIGHEST, "skew": SKEWNESS, "kurt": KURTOSIS}
    out = summarise(df, [group], "price", stats, {**MEDIAN, **QUARTILES})
    return _rounded(
        out.select(group, "n", "mean", "median", "std", "min", "max", "q25", "q75", "skew", "kurt"),
        {"mean": 2, "median": 2, "std": 2, "q25": 2, "q75": 2, "skew": 3, "kurt": 3},
    )


def median_pivot(df: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Source x category matrix of medians. Only the small table of medians is pivoted."""
    medians = localize(quantiles(df, ["source", "category"], "price", MEDIAN))
    wide = medians.groupBy("source").pivot("category", categories).agg(F.round(F.first("median"), 2))
    return wide


def wide_blocks(cells: DataFrame, row: str, col: str, value: str, width: int = 1000) -> DataFrame:
    """(row, block, cells): a wide result for any number of labels, as maps from label to value.

    A pivot makes a column of each label, which ends at some thousands. Here labels are dealt to blocks of about ``width``
    by a hash of their name, so that a row of the result stays small, and cells without a value take no room.
    """
    labels = cells.select(col).distinct().count()
    blocks = max(1, -(-labels // width))
    hashed = F.conv(F.substring(F.md5(F.col(col).cast("string")), 1, 8), 16, 10).cast("long")
    entries = F.array_sort(F.collect_list(F.struct(F.col(col).alias("key"), F.col(value).alias("value"))))
    placed = cells.where(F.col(value).isNotNull() & F.col(col).isNotNull()).withColumn("block", (hashed % blocks).cast("int"))
    return placed.groupBy(row, "block").agg(F.map_from_entries(entries).alias("cells"))


def median_blocks(df: DataFrame, row: str = "source", col: str = "category", value: str = "price", width: int = 1000) -> DataFrame:
    """``median_pivot`` for more labels than a pivot takes."""
    medians = quantiles(df, [row, col], value, MEDIAN).withColumn("median", F.round("median", 2))
    # Written once: the labels are counted before the blocks are built.
    return wide_blocks(stash(medians, "medians"), row, col, "median", width)


def daily_average(df: DataFrame, digits: int = 2) -> DataFrame:
    return df.groupBy("scraped_date", "source").agg(
        F.round(F.avg("price"), digits).alias("avg_price"), F.count("price").alias("n")
    )


def daily_volume(df: DataFrame) -> DataFrame:
    return df.groupBy("scraped_date").agg(F.count(F.lit(1)).alias("records"))


def observed_changes(df: DataFrame, tie_break: list[str] | None = None, limit_pct: float = 200.0) -> DataFrame:
    """Unrounded change against the previous observation; jumps of ``limit_pct`` and more are errors.

    Rows are walked in order, with all their columns: give those that are wanted.
    """
    changed = lag_price(df, ["scraped_at", *(tie_break or [])])
    pct = c.price_change_pct("price", "prev_price", None)
    return changed.withColumn("pct_change", pct).where(F.abs("pct_change") < limit_pct)


def change_volatility(changes: DataFrame, group: str = "source") -> DataFrame:
    share = lambda cond: F.round(F.avg(F.when(cond, 1.0).otherwise(0.0)) * 100, 1)
    return changes.groupBy(group).agg(
        F.round(F.avg("pct_change"), 3).alias("mean_chg"),
        F.round(F.stddev_samp("pct_change"), 3).alias("std_chg"),
        share(F.col("pct_change") < -5).alias("pct_drops"),
        share(F.col("pct_change") > 5).alias("pct_spikes"),
    )


def _fences(k: float) -> tuple[Column, Column]:
    iqr = F.col("q75") - F.col("q25")
    return F.col("q25") - k * iqr, F.col("q75") + k * iqr


def with_zscore(df: DataFrame, group: str = "source") -> DataFrame:
    """Population z-score of the price within its group."""
    moments = df.groupBy(group).agg(F.avg("price").alias("_mean"), F.stddev_pop("price").alias("_std"))
    return (
        attach(df, moments, [group])
        .withColumn("z", F.try_divide(F.col("price") - F.col("_mean"), F.col("_std")))
        .drop("_mean", "_std")
    )


def outlier_summary(df: DataFrame, group: str = "source", k: float = 1.5, z: float = 3.0) -> DataFrame:
    """Outliers by the quartile fence and by z-score. The second pass runs over value counts."""
    counted = count_values(df, [group], "price")
    stats = {"mean": MEAN, "sd": STD_POP}
    limits = summarise(df, [group], "price", stats, QUARTILES, counted)
    low, high = _fences(k)
    limits = limits.withColumn("lower", low).withColumn("upper", high).drop("q25", "q75")
    counts = attach(counted.table, limits, [group])
    price, n = F.col("price"), F.col("n")
    fenced = F.sum(F.when((price < F.col("lower")) | (price > F.col("upper")), n).otherwise(0))
    extreme = F.sum(F.when(F.abs((price - F.col("mean")) / F.nullif("sd", F.lit(0.0))) > z, n).otherwise(0))
    out = counts.groupBy(group).agg(
        F.sum("n").alias("n"),
        fenced.alias("iqr_outliers"),
        extreme.alias("z_outliers"),
        F.first("lower").alias("lower_fence"),
        F.first("upper").alias("upper_fence"),
    )
    pct = lambda x: F.round(F.col(x) / F.col("n") * 100, 1)
    return out.select(
        group,
        "n",
        "iqr_outliers",
        pct("iqr_outliers").alias("iqr_pct"),
        "z_outliers",
        pct("z_outliers").alias("z_pct"),
        F.round("lower_fence", 2).alias("lower_fence"),
        F.round("upper_fence", 2).alias("upper_fence"),
    )


def cv_ranking(df: DataFrame, group: str = "source") -> DataFrame:
    """Coefficient of variation in percent, 0 where the mean is not positive; largest first."""
    cv = F.when(F.avg("price") > 0, F.round(F.stddev_samp("price") / F.avg("price") * 100, 1)).otherwise(0.0)
    return df.groupBy(group).agg(cv.alias("cv")).orderBy(F.desc("cv"), group)


def histogram(
    df: DataFrame,
    col: str = "price",
    bins: int = 60,
    group: str = "source",
    log: bool = False,
    span: tuple[float, float] | None = None,
) -> DataFrame:
    """Rows per equal-width bin and group; with ``log`` the bins are equal on the log10 scale."""
    value = F.log10(col) if log else F.col(col).cast("double")
    rows = df.where(F.col(col) > 0 if log else F.col(col).isNotNull()).select(group, value.alias("_v"))
    if span is None:
        ends = rows.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    else:
        lo, hi = F.lit(float(span[0])), F.lit(float(span[1]))
        rows = rows.where(F.col("_v").between(lo, hi))
    numbered = rows.withColumn("_lo", lo).withColumn("_w", (hi - lo) / bins)
    place = F.when(F.col("_w") == 0, 0).otherwise(F.floor((F.col("_v") - F.col("_lo")) / F.col("_w")))
    return (
        numbered.withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
        .groupBy(group, "bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.first(F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_start"),
            F.first(F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("bin_end"),
        )
    )


def box_stats(df: DataFrame, group: str = "source", k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (most distant values inside the fences) and number of points outside."""
    counted = count_values(df, [group], "price")
    quarts = counted.quantiles({**QUARTILES, **MEDIAN})
    low, high = _fences(k)
    limits = quarts.withColumn("lower", low).withColumn("upper", high)
    counts = attach(counted.table, limits, [group])
    inside = F.col("price").between(F.col("lower"), F.col("upper"))
    return counts.groupBy(group).agg(
        F.first("q25").alias("q25"),
        F.first("median").alias("median"),
        F.first("q75").alias("q75"),
        F.min(F.when(inside, F.col("price"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("price"))).alias("whisker_high"),
        F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("n_outliers"),
    )


def box_outliers(df: DataFrame, group: str = "source", k: float = 1.5) -> DataFrame:
    """The rows outside the fences of their group."""
    low, high = _fences(k)
    limits = quantiles(df, [group], "price", QUARTILES).select(group, low.alias("_low"), high.alias("_high"))
    return (
        attach(df, limits, [group])
        .where((F.col("price") < F.col("_low")) | (F.col("price") > F.col("_high")))
        .drop("_low", "_high")
    )


def density_grid(df: DataFrame, group: str = "source", bins: int = 200, points: int = 64) -> DataFrame:
    """Gaussian kernel density by group on an even grid from its smallest to its largest price.

    Rows are first counted into ``bins`` bins of their group's range; each bin then adds its weight to
    the grid points, so the second step handles bins x points rows per group whatever the data size.
    """
    stats = {"_n": COUNT, "_sd": STD, "_lo": LOWEST, "_hi": HIGHEST}
    limits = summarise(df, [group], "price", stats, QUARTILES)
    spread = F.least(F.col("_sd"), (F.col("q75") - F.col("q25")) / 1.349)
    limits = limits.withColumn("_h", 1.059 * spread * F.pow(F.col("_n"), F.lit(-0.2))).where(
        (F.col("_h") > 0) & (F.col("_hi") > F.col("_lo"))
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    rows = attach(df.select(group, "price"), limits, [group], how="inner")
    binned = rows.withColumn(
        "_bin", F.least(F.floor((F.col("price") - F.col("_lo")) / width), F.lit(bins - 1)).cast("int")
    )
    keys = [group, "_bin", "_n", "_lo", "_hi", "_h"]
    weights = binned.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"))
    centre = F.col("_lo") + (F.col("_bin") + 0.5) * width
    at = F.col("_lo") + F.col("point") * (F.col("_hi") - F.col("_lo")) / (points - 1)
    z = (at - centre) / F.col("_h")
    kernel = F.exp(-z * z / 2) / F.sqrt(F.lit(2.0) * F.pi())
    return (
        weights.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", at)
        .withColumn("_k", F.col("_m") * kernel / (F.col("_n") * F.col("_h")))
        .groupBy(group, "point")
        .agg(F.first("x").alias("x"), F.sum("_k").alias("density"))
    )


def top_categories(df: DataFrame, k: int = 10, col: str = "category") -> DataFrame:
    """Most frequent labels; equal counts by name."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), col)
        .limit(k)
    )


def top_by_median(df: DataFrame, k: int = 10, col: str = "category", value: str = "price") -> DataFrame:
    """The ``k`` labels with the highest median, with their number of rows; equal medians by name."""
    table = summarise(df.where(F.col(col).isNotNull()), [col], value, {"n": COUNT}, {"median": 0.5})
    return table.select(col, "n", F.round("median", 2).alias("median")).orderBy(F.desc_nulls_last("median"), col).limit(k)


def in_top_categories(df: DataFrame, k: int = 10, col: str = "category", by_median: bool = False) -> DataFrame:
    """Rows whose label is one of the ``k`` most frequent, or of those with the highest median."""
    top = (top_by_median if by_median else top_categories)(df, k, col).select(col)
    local = collect_small(top)
    # More labels than a broadcast may hold are joined by the label: rows of a hot one are split by adaptive execution.
    return df.join(top if local is None else F.broadcast(local), col, "left_semi")
