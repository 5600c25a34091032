"""Read-side queries over the marts: search, paging, key figures and rankings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import cleaning as c
from tidemark.operators.small import attach, localize
from tidemark.plans.marts import as_date

# Sort keys offered to a reader -> column and direction.
SORT_KEYS = {
    "price_asc": ("price", True),
    "price_desc": ("price", False),
    "rating_desc": ("rating", False),
    "title_asc": ("title", True),
}
MAX_PAGE = 1000


def search(
    df: DataFrame,
    source: str | None = None,
    title: str | None = None,
    text: str | None = None,
    availability: str | None = None,
    price_between: tuple[float, float] | None = None,
) -> DataFrame:
    """Filters of the product list; ``text`` looks into title and category."""
    if source:
        df = df.where(F.col("source") == source)
    if title:
        df = df.where(_has("title", title))
    if text:
        df = df.where(_has("title", text) | _has("category", text))
    if availability:
        df = df.where(F.col("availability") == availability)
    if price_between:
        df = df.where(F.col("price").between(*price_between))
    return df


def _has(col: str, term: str) -> Column:
    return F.contains(F.lower(F.coalesce(F.col(col), F.lit(""))), F.lit(term.lower()))


def sort_products(df: DataFrame, key: str = "price_asc") -> DataFrame:
    col, ascending = SORT_KEYS[key]
    first = F.asc_nulls_last(col) if ascending else F.desc_nulls_last(col)
    return df.orderBy(first, "product_id")


def page(df: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    """One page in the order source, title, product_id."""
    if not 1 <= limit <= MAX_PAGE or offset < 0:
        raise ValueError("limit must be 1..1000 and offset >= 0")
    return df.orderBy("source", "title", "product_id").offset(offset).limit(limit)


def page_with_total(df: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    """The page, each row with the number of rows before paging."""
    total = df.agg(F.count(F.lit(1)).alias("n"))
    return page(df, limit, offset).withColumn("total", total.scalar())


def get_product(df: DataFrame, product_id: str) -> DataFrame:
    return df.where(F.col("product_id") == product_id).limit(1)


def product_history(
    history: DataFrame, product_id: str, days: int = 30, as_of: dt.date | str | Column | None = None
) -> DataFrame:
    if not 1 <= days <= 365:
        raise ValueError("days must be 1..365")
    recent = F.col("scraped_date") >= F.date_sub(as_date(as_of), days)
    return history.where((F.col("product_id") == product_id) & recent).orderBy("scraped_at")


def alerts_at_least(alerts: DataFrame, min_drop_pct: float = 5.0, source: str | None = None) -> DataFrame:
    hit = alerts.where(F.col("price_change_pct") <= -min_drop_pct)
    if source:
        hit = hit.where(F.col("source") == source)
    return hit.orderBy("price_change_pct", "product_id", "scraped_at")


def distinct_values(df: DataFrame, col: str = "source") -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def live_kpis(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("products"),
        F.count_distinct("source").alias("sources"),
        F.round(F.avg("price"), 2).alias("avg_price"),
        F.min("price").alias("lowest"),
        F.max("price").alias("highest"),
    )


def market_share(df: DataFrame, group: str = "source") -> DataFrame:
    """Rows by group and their share of all rows. The window runs over the grouped counts."""
    counts = localize(df.groupBy(group).agg(F.count(F.lit(1)).alias("n")))
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("share_pct", F.round(F.col("n") / total * 100, 2)).orderBy(F.desc("n"), group)


def alert_kpis(alerts: DataFrame) -> DataFrame:
    return alerts.agg(
        F.count(F.lit(1)).alias("alerts"),
        F.min("price_change_pct").alias("biggest_drop"),
        F.count_distinct("source").alias("sources_hit"),
        F.count_if(F.col("price_change_pct") <= -20).alias("severe"),
    )


def severity_distribution(alerts: DataFrame) -> DataFrame:
    """Alerts by severity; classes without any do not appear."""
    return (
        alerts.where(F.col("price_change_pct") <= -5)
        .groupBy(c.severity("price_change_pct").alias("severity"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_drops(alerts: DataFrame, n: int = 12, title_chars: int = 62) -> DataFrame:
    """Worst drops first, with a shortened title."""
    return (
        alerts.orderBy("price_change_pct", "product_id", "scraped_at")
        .limit(n)
        .withColumn("title", c.truncate(F.coalesce("title", "product_id"), title_chars))
        .withColumn("severity", c.severity("price_change_pct"))
    )


def market_totals(stats: DataFrame) -> DataFrame:
    return stats.agg(
        F.sum("product_count").alias("total_products"),
        F.sum("observation_count").alias("total_observations"),
        F.count(F.lit(1)).alias("markets"),
    )


def period_summary(history: DataFrame, product_id: str | None = None) -> DataFrame:
    """High, low, latest price and change from first to last observation, by product."""
    if product_id is not None:
        history = history.where(F.col("product_id") == product_id)
    first, last = F.min_by("price", "scraped_at"), F.max_by("price", "scraped_at")
    out = history.groupBy("product_id").agg(
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        first.alias("first_price"),
        last.alias("current_price"),
    )
    return out.withColumn("change_abs", F.round(F.col("current_price") - F.col("first_price"), 2)).withColumn(
        "change_pct", c.price_change_pct("current_price", "first_price")
    )


def product_labels(history: DataFrame) -> DataFrame:
    """Title of the earliest observation of each product, the id where it has none."""
    title = F.min_by("title", F.when(F.col("title").isNotNull(), F.col("scraped_at")))
    return history.groupBy("product_id").agg(F.coalesce(title, F.first("product_id")).alias("label"))


def flag_drops(history: DataFrame, pct: float = -5.0) -> DataFrame:
    return history.withColumn("is_drop", F.coalesce(F.col("price_change_pct") <= pct, F.lit(False)))


# Metric column -> label.
METRIC_LABELS = {"min_price": "Min", "avg_price": "Avg", "median_price": "Median", "max_price": "Max"}


def price_ranges(stats: DataFrame) -> DataFrame:
    """Min, average, median and max as one row each, labelled."""
    present = columns_present(stats, list(METRIC_LABELS))
    return stats.unpivot(["source", "currency"], present, "metric", "price").withColumn(
        "metric", c.lookup("metric", METRIC_LABELS)
    )


def columns_present(df: DataFrame, wanted: list[str]) -> list[str]:
    return [x for x in wanted if x in df.columns]


def product_table(df: DataFrame) -> DataFrame:
    wanted = ["title", "source", "price", "currency", "availability", "category", "rating", "scraped_at"]
    return df.select(*columns_present(df, wanted))


def with_source_label(df: DataFrame, sources: DataFrame, default: str = "?") -> DataFrame:
    """Left lookup of a source's label in a small dimension (source, label)."""
    return attach(df, sources.select("source", "label"), ["source"]).withColumn(
        "label", F.coalesce("label", F.lit(default))
    )
