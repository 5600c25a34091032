"""Daily statistics of each product as mergeable partial states, and rolling features over days.

A partial state is one row of a product and day: the number of prices, their exact total, the sum of squared deviations
from their mean, the least and the greatest, and the first and the last by time. States of parts of the data merge into the state of
the whole, so a table of them can be kept by loads (``sources.daily_table``) and windows over days read one row a day,
however many prices a product has in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["product_id", "scraped_date"]
STATE = "product_id string, scraped_date date, n long, total decimal(38,8), m2 double, low double, high double, opened struct<at: timestamp, price: double>, closed struct<at: timestamp, price: double>"
#: Totals are decimal, so that averages do not depend on the order of rows or on how loads were cut.
EXACT = "decimal(28,8)"


def daily_states(df: DataFrame) -> DataFrame:
    """One partial state for each product and day with a price, combined in every task before the shuffle.

    Rows without a price (null or NaN), time or product say nothing. A product that owns a third of all rows sends one
    row a day and task.
    """
    rows = df.where(F.col("price").isNotNull() & ~F.isnan("price") & F.col("scraped_at").isNotNull() & F.col("product_id").isNotNull())
    at = F.struct(F.col("scraped_at").cast("timestamp").alias("at"), F.col("price").cast("double").alias("price"))
    rows = rows.select("product_id", F.to_date("scraped_at").alias("scraped_date"), F.col("price").cast("double").alias("price"), at.alias("_at"))
    return rows.groupBy(*KEYS).agg(
        F.count("price").alias("n"),
        F.sum(F.col("price").cast(EXACT)).alias("total"),
        # The built-in aggregate adds deviations without cancelling; equal prices deviate by nothing.
        F.when(F.min("price") == F.max("price"), 0.0).otherwise(F.var_pop("price") * F.count("price")).alias("m2"),
        F.min("price").alias("low"),
        F.max("price").alias("high"),
        F.min("_at").alias("opened"),
        F.max("_at").alias("closed"),
    )


def _mean() -> Column:
    return F.col("total").cast("double") / F.col("n")


def merge_states(states: DataFrame) -> DataFrame:
    """One state for each product and day from states of parts of the data (one row a part, so few rows of a key)."""
    parts = F.array_sort(F.collect_list(F.struct("n", _mean().alias("mean"), "m2")))
    merged = states.groupBy(*KEYS).agg(
        parts.alias("_parts"), F.sum("total").cast("decimal(38,8)").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("opened").alias("opened"), F.max("closed").alias("closed")
    )
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(a: Column, b: Column) -> Column:
        n, away = a.n + b.n, b.mean - a.mean
        return F.struct(n.alias("n"), (a.mean + away * b.n / n).alias("mean"), (a.m2 + b.m2 + away * away * a.n * b.n / n).alias("m2"))

    return merged.withColumn("_s", F.aggregate("_parts", zero, add)).select(*KEYS, "_s.n", "total", "_s.m2", "low", "high", "opened", "closed")


def daily_price_stats(states: DataFrame) -> DataFrame:
    """The readable form: number of observations, average, bounds, sample deviation, first and last price of the day."""
    return states.select(
        *KEYS,
        F.col("n").alias("observations"),
        F.round(_mean(), 2).alias("avg_price"),
        F.col("low").alias("min_price"),
        F.col("high").alias("max_price"),
        F.round(F.sqrt(F.col("m2") / F.nullif(F.col("n") - 1, F.lit(0))), 2).alias("stddev_price"),
        F.col("opened.price").alias("open_price"),
        F.col("closed.price").alias("close_price"),
    )


def rolling_features(states: DataFrame, short: int = 7, long: int = 30) -> DataFrame:
    """Features of each product and day over the last ``short`` and ``long`` days, that day included.

    ``avg_7d`` and ``avg_30d`` are averages of all prices in the span, ``min_30d`` and ``max_30d`` their bounds,
    ``volatility`` their sample standard deviation, null for a single price; ``days_30d`` counts days with a price. The frames are
    ranges of days, so days without a price neither count nor shorten them. One exchange by product, of one row a
    product and day: a product that owns a third of all prices is as many rows as it has days.
    """
    product = Window.partitionBy("product_id")
    by_day = product.orderBy("_day")
    spans = {f"{k}d": by_day.rangeBetween(-(k - 1), 0) for k in (short, long)}
    wide = spans[f"{long}d"]
    # Squares are taken around the product's own level, so that large prices with small changes lose no digits.
    rows = states.withColumn("_day", F.unix_date("scraped_date")).withColumn("_away", _mean() - F.avg(_mean()).over(product))
    n, total = F.sum("n").over(wide), F.sum(F.col("n") * F.col("_away")).over(wide)
    squares = F.sum(F.col("m2") + F.col("n") * F.col("_away") * F.col("_away")).over(wide) - total * total / n
    flat = F.min("low").over(wide) == F.max("high").over(wide)
    deviation = F.when(n > 1, F.when(flat, 0.0).otherwise(F.sqrt(F.greatest(squares, F.lit(0.0)) / (n - 1))))
    return rows.select(
        *KEYS,
        *[F.round(F.sum("total").over(w).cast("double") / F.sum("n").over(w), 2).alias(f"avg_{name}") for name, w in spans.items()],
        F.min("low").over(wide).alias(f"min_{long}d"),
        F.max("high").over(wide).alias(f"max_{long}d"),
        F.round(deviation, 2).alias("volatility"),
        F.count(F.lit(1)).over(wide).alias(f"days_{long}d"),
    )


def latest_features(states: DataFrame, as_of, short: int = 7, long: int = 30) -> DataFrame:
    """Features as seen on the day ``as_of`` (a date or its text), one row for each product with a price in the span.

    Only the days of the span are read, a filter that reaches a table partitioned by day; no window is needed.
    """
    day = F.lit(as_of).cast("date")
    span = states.where((F.col("scraped_date") <= day) & (F.col("scraped_date") > F.date_sub(day, long)))
    recent = F.col("scraped_date") > F.date_sub(day, short)
    n = F.sum("n")
    means = span.groupBy("product_id").agg(
        F.round(F.sum(F.when(recent, F.col("total"))).cast("double") / F.sum(F.when(recent, F.col("n"))), 2).alias(f"avg_{short}d"),
        F.round(F.sum("total").cast("double") / n, 2).alias(f"avg_{long}d"),
        F.min("low").alias(f"min_{long}d"),
        F.max("high").alias(f"max_{long}d"),
        F.count(F.lit(1)).alias(f"days_{long}d"),
    )
    return means.withColumn("as_of", day)
