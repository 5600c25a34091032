"""Reading and writing observations, marts and reports."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.cleaning import strip, to_number
from tidemark.operators.small import collect_small
from tidemark.schema import PRICE_SCHEMA
from tidemark.session import stash

log = logging.getLogger(__name__)

CORRUPT = "_corrupt_record"
# Keeps the microseconds that the default JSON format drops.
JSON_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """All JSON lines below ``path``. Unknown fields are ignored, missing ones are null and records that
    cannot be read keep their text in ``_corrupt_record``; files that cannot be read are passed over.
    Price and rating may be numbers or their text; any other text there is read as null."""
    lines = (
        spark.read.option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").text(path)
    )
    return parse_records(lines.where(strip("value") != "")).drop("value")


def parse_records(df: DataFrame, text: str = "value") -> DataFrame:
    """The same for JSON texts in a column; other columns are kept."""
    number = {f.name for f in PRICE_SCHEMA.fields if f.dataType == T.DoubleType()}
    fields = [T.StructField(f.name, T.StringType()) if f.name in number else f for f in PRICE_SCHEMA.fields]
    schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = df.withColumn("_r", F.from_json(text, schema, options))
    return parsed.select(
        *df.columns, *[(to_number(f"_r.{x}") if x in number else F.col(f"_r.{x}")).alias(x) for x in schema.fieldNames()]
    )


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), df.where(F.col(CORRUPT).isNotNull())


def path_exists(spark: SparkSession, path: str) -> bool:
    """One call of the file system, whatever is below the path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file written by the driver, replaced if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


MANY_DAYS = 10_000
RANGES = "low timestamp, high timestamp, scraped_date date"


def load_raw(df: DataFrame, path: str) -> DataFrame:
    """Append observations to the raw table, partitioned by day, and return what was new.

    A repeated load adds nothing: a record is known by all its fields, null or not. Rows of one product and
    time that differ in anything are different records.

    Beside the days lie ``_loads``, a mark for each load by the content of its rows, and ``_ranges``, the spans of time
    that loads brought for each day. A load that is marked is not compared at all; of another only the days are
    read whose spans meet an earlier one, and within them only the span. Rows without a time are always
    compared. Spans are written before the rows and the mark after them, so that a load that died in between is
    compared with what it left. One writer at a time.
    """
    spark = df.sparkSession
    batch = stash(df.withColumn("scraped_date", F.to_date("scraped_at")).distinct(), "load")
    mark = f"{path}/_loads/{_fingerprint(batch)}"
    if path_exists(spark, mark):
        return batch.limit(0)
    at = F.col("scraped_at").cast("timestamp")
    spans = batch.groupBy("scraped_date").agg(F.min(at).alias("low"), F.max(at).alias("high")).select("low", "high", "scraped_date")
    few = collect_small(spans, MANY_DAYS)
    fresh = batch
    if path_exists(spark, path):
        present = _present(spark, path, batch, few)
        fresh = batch if present is None else batch.subtract(present.select(batch.columns))
    # Few files for each day; a day with very many rows is still split over tasks.
    (spans if few is None else few).repartition(1).write.mode("append").partitionBy("scraped_date").parquet(f"{path}/_ranges")
    ordered = fresh.hint("rebalance", "scraped_date").sortWithinPartitions("scraped_date", "scraped_at")
    ordered.write.mode("append").partitionBy("scraped_date").parquet(path)
    write_text(spark, mark, "")
    return fresh


def _fingerprint(batch: DataFrame) -> str:
    """The number of rows and two hashes of their content, in any order."""
    every = [F.col(f"`{x}`") for x in batch.columns]
    hashes = [F.xxhash64(F.lit(seed), *every, *[x.isNull() for x in every]) for seed in (1, 2)]
    row = batch.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.bit_xor(h), F.lit(0)).alias(f"h{k}") for k, h in enumerate(hashes)]).first()
    return f"{row.n}-{row.h0:x}-{row.h1:x}".replace("--", "-m")


def _present(spark: SparkSession, path: str, batch: DataFrame, spans: DataFrame | None) -> DataFrame | None:
    """Rows of the table that a batch must be compared with; None if it meets no earlier span."""
    if spans is None:
        return spark.read.schema(batch.schema).parquet(path)
    own = {r.scraped_date: (r.low, r.high) for r in spans.collect()}
    folder = {day: f"scraped_date={day or '__HIVE_DEFAULT_PARTITION__'}" for day in own}
    known = [day for day in own if path_exists(spark, f"{path}/_ranges/{folder[day]}")]
    if not known:
        return None
    reader = spark.read.schema(RANGES).option("basePath", f"{path}/_ranges")
    earlier = reader.parquet(*[f"{path}/_ranges/{folder[day]}" for day in known])
    mine = F.broadcast(spans.select(F.col("scraped_date").alias("_d"), F.col("low").alias("_l"), F.col("high").alias("_h")))
    meets = F.col("scraped_date").eqNullSafe(F.col("_d")) & (F.col("_d").isNull() | ((F.col("low") <= F.col("_h")) & (F.col("high") >= F.col("_l"))))
    days = [r[0] for r in earlier.join(mine, meets).select("scraped_date").distinct().collect()]
    found = [f"{path}/{folder[day]}" for day in days if path_exists(spark, f"{path}/{folder[day]}")]
    if not found:
        return None
    rows = spark.read.schema(batch.schema).option("basePath", path).parquet(*found)
    bounds = [own[day] for day in days if day is not None]
    if None in days or not bounds:
        return rows
    # The bounds reach the scan; files are sorted by time, so that row groups outside them are skipped.
    return rows.where(F.col("scraped_at").between(F.lit(min(low for low, _ in bounds)), F.lit(max(high for _, high in bounds))))


def write_jsonl(df: DataFrame, folder: str) -> None:
    """JSON lines in one sub-folder per source; the source stays in each record."""
    df.withColumn("spider", F.col("source")).write.mode("append").options(**JSON_TIME).partitionBy("spider").json(folder)


def read_mart(spark: SparkSession, name: str) -> DataFrame:
    """A mart by table name, or by path when it holds a slash."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def first_available(sources: Iterable[Callable[[], DataFrame]]) -> DataFrame:
    """First source that can be read and has a row."""
    for source in sources:
        try:
            df = source()
            if not df.isEmpty():
                return df
        except PySparkException as err:
            log.warning("source not available: %s", err)
    raise LookupError("no source has data")


def assert_non_empty(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("no rows landed")
    return df


def materialize(df: DataFrame, name: str, kind: str, path: str | None = None) -> DataFrame:
    """Staging as a view, intermediate inline, marts as a table (or as files when ``path`` is given)."""
    if kind == "inline":
        return df
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if kind != "table":
        raise ValueError(f"unknown kind {kind!r}")
    if path:
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        return df.sparkSession.read.parquet(f"{path}/{name}")
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def write_history(history: DataFrame, path: str) -> None:
    """History partitioned by day and ordered by product, so that point and range reads skip files."""
    (
        history.repartitionByRange("scraped_date", "product_id")
        .sortWithinPartitions("scraped_date", "product_id", "scraped_at")
        .write.mode("overwrite")
        .partitionBy("scraped_date")
        .parquet(path)
    )


def write_stat_tables(tables: dict[str, DataFrame], path: str, run_date: str) -> None:
    """One result table each, stamped with the date of the run."""
    for name, df in tables.items():
        df.withColumn("run_date", F.lit(run_date).cast("date")).write.mode("overwrite").parquet(f"{path}/{name}")


def dq_report(checks: DataFrame, rows: int, columns: list[str]) -> DataFrame:
    """The check results (some twenty rows) as one nested record."""
    return checks.agg(
        F.lit(rows).cast("long").alias("rows"),
        F.array(*[F.lit(x) for x in columns]).alias("columns"),
        F.collect_list(F.struct(F.col("check").alias("name"), "passed", "detail")).alias("checks"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.round(F.avg(F.col("passed").cast("double")) * 100, 1).alias("score_pct"),
    ).withColumn("run_at", F.current_timestamp())


def write_dq_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)
