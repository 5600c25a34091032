"""Event rates and a live table of current prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.history import latest_row
from tidemark.streaming.ingest import Sink, start

WINDOW_SECONDS = 300


#: Size of a quantile sketch: at 200 a rank is off by less than 1.65 % of the window's events with probability 0.99.
SKETCH_K = 200
SKETCH_RANK_ERROR = 0.0165
SHARES = {"p50": 0.5, "p95": 0.95}


def rate_counts(
    df: DataFrame, time: str = "scraped_at", value: str = "price", is_error: Column | None = None, seconds: int = WINDOW_SECONDS, late: str = "10 minutes"
) -> DataFrame:
    """Events and errors of each window and distinct value: what exact rates are made from.

    Each value of a window is a row of state by itself, so no buffer holds a window, and a stream's state spreads over
    tasks and may live on disk. Counts are combined before the shuffle.
    """
    error = F.lit(False) if is_error is None else is_error
    windowed = df.withWatermark(time, late) if df.isStreaming else df
    counts = windowed.groupBy(F.window(time, f"{seconds} seconds").alias("w"), F.col(value).alias("value")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(error).alias("errors")
    )
    return counts.select(F.col("w.start").alias("window_start"), "value", "events", "errors")


def exact_rates(counts: DataFrame, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Rates of the windows of ``rate_counts``; the quantiles are values of the window, those at the rank rounded up.

    Values of a window are sorted by the engine (which spills), never gathered in one buffer.
    """
    in_order = Window.partitionBy("window_start").orderBy(F.asc_nulls_last("value"))
    valued = F.when(F.col("value").isNotNull(), F.col("events"))
    placed = counts.select(
        "*",
        F.sum(valued).over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"),
        F.sum(valued).over(Window.partitionBy("window_start")).alias("_all"),
    )
    reached = {name: F.min(F.when(F.col("_upto") >= F.ceil(F.col("_all") * share), F.col("value"))) for name, share in SHARES.items()}
    return placed.groupBy("window_start").agg(*_rate_columns(F.sum("events"), F.sum("errors"), reached, seconds))


def event_rates(
    df: DataFrame,
    time: str = "scraped_at",
    value: str = "price",
    is_error: Column | None = None,
    seconds: int = WINDOW_SECONDS,
    late: str = "10 minutes",
    approx: bool = False,
) -> DataFrame:
    """Events per second, error share and p50/p95 of a value by time window.

    Exact quantiles come from counts of distinct values (a stream keeps ``rate_counts``; ``read_rates`` finishes them).
    With ``approx`` a window keeps a KLL sketch of SKETCH_K, bounded whatever the number of values, and merged from
    the sketches of tasks and batches; its ranks are off by less than SKETCH_RANK_ERROR with probability 0.99.
    """
    if not approx:
        counts = rate_counts(df, time, value, is_error, seconds, late)
        return counts if df.isStreaming else exact_rates(counts, seconds)
    error = F.lit(False) if is_error is None else is_error
    windowed = df.withWatermark(time, late) if df.isStreaming else df
    state = windowed.groupBy(F.window(time, f"{seconds} seconds").alias("w")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(error).alias("errors"), F.kll_sketch_agg_double(value, F.lit(SKETCH_K)).alias("_sketch")
    )
    found = {name: F.kll_sketch_get_quantile_double("_sketch", F.lit(share)) for name, share in SHARES.items()}
    return state.select(F.col("w.start").alias("window_start"), *_rate_columns(F.col("events"), F.col("errors"), found, seconds))


def _rate_columns(events: Column, errors: Column, quantiles: dict[str, Column], seconds: int) -> list[Column]:
    return [
        events.alias("events"),
        (events / seconds).alias("events_per_sec"),
        (errors / events).alias("error_ratio"),
        *[x.alias(name) for name, x in quantiles.items()],
    ]


def start_rates(rates: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write every changed window of each batch; ``read_rates`` keeps the last state of a window."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        rates.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_rates(spark: SparkSession, path: str, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Rates from the last state of each window, or of each window and value if the stream kept counts."""
    states = spark.read.parquet(path)
    counted = "value" in states.columns
    w = Window.partitionBy("window_start", *(["value"] if counted else [])).orderBy(F.desc("batch"))
    last = states.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1).drop("rn", "batch")
    return exact_rates(last, seconds) if counted else last


def current_sink(path: str, tie_break: list[str] | None = None) -> Sink:
    """Append the latest row of each product in the batch. Old batches are merged by ``read_current``
    and dropped by ``compact_current``, so no state grows inside the stream."""

    def write(batch: DataFrame, batch_id: int) -> None:
        latest_row(batch, ["product_id"], tie_break).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return Sink("current", write)


def start_current(df: DataFrame, path: str, checkpoint: str, tie_break: list[str] | None = None) -> StreamingQuery:
    return start(df, [current_sink(path, tie_break)], checkpoint)


def read_current(spark: SparkSession, path: str, tie_break: list[str] | None = None) -> DataFrame:
    return latest_row(spark.read.parquet(path), ["product_id"], tie_break).drop("batch")


def compact_current(spark: SparkSession, path: str, target: str, tie_break: list[str] | None = None) -> None:
    """One row per product in a new folder, as batch -1 of a fresh log."""
    read_current(spark, path, tie_break).write.mode("overwrite").parquet(f"{target}/batch=-1")
