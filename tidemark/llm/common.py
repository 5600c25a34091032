"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import fresh_dir, prepare

#: Rows of an Arrow batch: texts may be long, and a batch is held in memory as a whole.
BATCH_ROWS = 512
WORD = r"[^\x20\x09-\x0D]+"


def ready(spark: SparkSession) -> SparkSession:
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go when each is done; a lost executor's are made again meanwhile as usual."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and go on from the written table; its shuffles are removed at once."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for each row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def crc_mod(key: str, n: int) -> Column:
    return F.pmod(F.crc32(F.col(key).cast("string")), F.lit(n))


def unit_hash(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a SHA-256 of seed and columns."""
    text = F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
