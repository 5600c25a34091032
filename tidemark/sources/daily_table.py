"""A table of daily partial states that is kept by loads: only the days of a load are read and replaced.

Below the folder: ``table`` by day, ``pending/<load>`` with the merged days of a load, and ``loads/load=<load>``, the
manifest. A load is first merged into ``pending``, then its days are swapped into ``table``, then it enters the manifest.
A load that died in between is simply given again: merged days that are complete are swapped once more, which gives the
same days, and a load in the manifest is left alone. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.daily import STATE, daily_states, merge_states
from tidemark.operators.small import collect_small
from tidemark.session import stash
from tidemark.sources.files import path_exists

MANY_DAYS = 10_000
LOADS = "days long, rows long, load string"


def load_days(observations: DataFrame, path: str, load: str) -> bool:
    """Fold the prices of a load into the table below ``path``; False if the manifest has the load already.

    Loads are told apart by name, not by content: the same prices under another name count again.
    """
    spark = observations.sparkSession
    if path_exists(spark, f"{path}/loads/load={load}"):
        return False
    pending = f"{path}/pending/{load}"
    if not path_exists(spark, f"{pending}/_SUCCESS"):
        fresh = stash(daily_states(observations), "days")
        merged = fresh
        if path_exists(spark, f"{path}/table"):
            merged = merge_states(fresh.unionByName(_same_days(spark, f"{path}/table", fresh)))
        _by_day(merged, pending)
    done = spark.read.schema(STATE).parquet(pending)
    _by_day(done, f"{path}/table", partitionOverwriteMode="dynamic")
    counts = done.agg(F.count_distinct("scraped_date").alias("days"), F.count(F.lit(1)).alias("rows"))
    counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/loads/load={load}")
    return True


def _by_day(states: DataFrame, path: str, **options: str) -> None:
    # Few files for each day; a day with very many products is still split over tasks.
    states.hint("rebalance", "scraped_date").write.mode("overwrite").options(**options).partitionBy("scraped_date").parquet(path)


def _same_days(spark: SparkSession, table: str, fresh: DataFrame) -> DataFrame:
    """Rows of the table for the days of a load. Only the folders of these days are listed and read."""
    days = collect_small(fresh.select("scraped_date").distinct(), MANY_DAYS)
    if days is None:
        return spark.read.schema(STATE).parquet(table).join(fresh.select("scraped_date").distinct(), "scraped_date", "left_semi")
    folders = [folder for r in days.collect() if path_exists(spark, folder := f"{table}/scraped_date={r[0]}")]
    reader = spark.read.schema(STATE).option("basePath", table)
    return reader.parquet(*folders) if folders else spark.createDataFrame([], STATE)


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """The states of all loads that were swapped in."""
    return spark.read.schema(STATE).parquet(f"{path}/table")


def read_loads(spark: SparkSession, path: str) -> DataFrame:
    """The manifest: load, and how many days and rows it replaced."""
    return spark.read.schema(LOADS).parquet(f"{path}/loads")
