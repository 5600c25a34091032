"""The published tables: current prices, history, statistics and price-drop alerts."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.distribution import beside_quantiles
from tidemark.operators.history import dedupe_daily, price_changes
from tidemark.operators.staging import stage_prices
from tidemark.schema import CURRENT_COLUMNS, HISTORY_COLUMNS
from tidemark.session import stash
from tidemark.sources.files import materialize, read_mart, write_history

# Alert threshold in percent and look-back in days.
ALERT_DROP_PCT = 5
ALERT_WINDOW_DAYS = 7

QUARTILES = {"p25_price": 0.25, "median_price": 0.5, "p75_price": 0.75}


def as_date(as_of: dt.date | str | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def current_prices(deduped: DataFrame) -> DataFrame:
    """Latest observation of every product."""
    w = Window.partitionBy("product_id").orderBy(F.desc("scraped_at"))
    ranked = deduped.withColumn("rn", F.row_number().over(w))
    return ranked.where(F.col("rn") == 1).select(*CURRENT_COLUMNS)


def current_prices_by_join(deduped: DataFrame) -> DataFrame:
    """The same by an equi-join to the latest time of each product."""
    latest = deduped.groupBy("product_id").agg(F.max("scraped_at").alias("scraped_at"))
    return deduped.join(latest, ["product_id", "scraped_at"]).select(*CURRENT_COLUMNS)


def price_history(changes: DataFrame) -> DataFrame:
    return changes.select(*HISTORY_COLUMNS)


def price_stats(deduped: DataFrame, approx: bool = False) -> DataFrame:
    """Statistics by source and currency, rounded to two places."""
    by = ["source", "currency"]
    aggs = [
        F.count_distinct("product_id").alias("product_count"),
        F.count(F.lit(1)).alias("observation_count"),
        F.avg("price").alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.stddev_samp("price").alias("stddev_price"),
        F.min("scraped_date").alias("first_seen_date"),
        F.max("scraped_date").alias("last_updated_date"),
    ]
    if approx:
        points = F.percentile_approx("price", [0.25, 0.5, 0.75], 10_000).alias("_q")
        stats = deduped.groupBy(*by).agg(*aggs, points)
        for i, name in enumerate(QUARTILES):
            stats = stats.withColumn(name, F.col("_q")[i])
    else:
        rows = deduped.select(*by, "product_id", "price", "scraped_date")
        # Read twice below: a written copy spares a second deduplication.
        stats = beside_quantiles(rows if deduped.is_cached else stash(rows, "stats"), by, "price", aggs, QUARTILES)
    rounded = ["avg_price", "min_price", "max_price", "stddev_price", *QUARTILES]
    return stats.select(
        *by,
        "product_count",
        "observation_count",
        *[F.round(x, 2).alias(x) for x in rounded],
        "first_seen_date",
        "last_updated_date",
    )


def price_alerts(
    changes: DataFrame,
    as_of: dt.date | str | Column | None = None,
    drop_pct: float = ALERT_DROP_PCT,
    days: int = ALERT_WINDOW_DAYS,
) -> DataFrame:
    """Drops of at least ``drop_pct`` percent in the last ``days`` days before ``as_of``."""
    hit = (F.col("price_change_pct") <= -drop_pct) & (F.col("scraped_date") >= F.date_sub(as_date(as_of), days))
    return changes.where(hit).select(
        "product_id",
        "source",
        "title",
        "url",
        "currency",
        F.col("price").alias("current_price"),
        "prev_price",
        "price_change_pct",
        "price_change_abs",
        "prev_date",
        F.col("scraped_date").alias("alert_date"),
        "scraped_at",
    )


def build_marts(deduped: DataFrame, as_of: dt.date | str | Column | None = None) -> dict[str, DataFrame]:
    """All marts over one deduplicated relation."""
    changes = price_changes(deduped)
    return {
        "current_prices": current_prices(deduped),
        "price_history": price_history(changes),
        "price_stats": price_stats(deduped),
        "price_alerts": price_alerts(changes, as_of),
    }


def publish_marts(
    raw: DataFrame,
    path: str,
    as_of: dt.date | str | Column | None = None,
    tie_break: list[str] | None = None,
) -> dict[str, DataFrame]:
    """Build and write all marts below ``path``; the relation they share is kept while they are written."""
    deduped = dedupe_daily(stage_prices(raw), tie_break).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        written = {}
        for name, df in build_marts(deduped, as_of).items():
            if name == "price_history":
                write_history(df, f"{path}/{name}")
                written[name] = read_mart(raw.sparkSession, f"{path}/{name}")
            else:
                written[name] = materialize(df, name, "table", path)
        return written
    finally:
        deduped.unpersist()
