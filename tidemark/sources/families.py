"""The price and the metadata family as tables in one bucket layout, so that joining them moves no row.

Prices are many rows of a product, metadata is one. Both are bucketed by product and salt: the salt of a price is a hash
of its time, and metadata has a row for each salt. A product that owns a third of all prices is spread over as many
buckets as there are salts, and every price still meets its metadata within a bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.history import last_non_null
from tidemark.session import fresh_dir

PRICE_FAMILY = ["price", "currency"]
METADATA_FAMILY = ["title", "category", "rating", "url", "source"]
KEYS = ["product_id", "salt"]
BUCKETS = 32
SALTS = 8


def metadata_of(observations: DataFrame, order: list[str]) -> DataFrame:
    """One row a product: the last value that is not null of each metadata column."""
    rows = observations.select("product_id", *order, *METADATA_FAMILY)
    return last_non_null(rows, ["product_id"], order).select("product_id", *METADATA_FAMILY)


def write_families(
    observations: DataFrame, name: str, order: list[str], extra: list[str] | None = None, buckets: int = BUCKETS, salts: int = SALTS
) -> None:
    """Tables ``<name>_prices`` and ``<name>_metadata``; rows without a product are left out. ``order`` are the time and its tie breaks."""
    spark = observations.sparkSession
    known = observations.where(F.col("product_id").isNotNull())
    columns = list(dict.fromkeys(["product_id", *order, *PRICE_FAMILY, *(extra or [])]))
    prices = known.select(*columns).withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    _write(spark, prices, f"{name}_prices", buckets)
    _write(spark, metadata_of(known, order).select("*", every), f"{name}_metadata", buckets)


def _write(spark: SparkSession, df: DataFrame, table: str, buckets: int) -> None:
    # One file a bucket.
    writer = df.repartition(buckets, *KEYS).write.mode("overwrite").option("path", fresh_dir(spark, table)).format("parquet")
    writer.bucketBy(buckets, *KEYS).sortBy(*KEYS).saveAsTable(table)


def prices_with_metadata(spark: SparkSession, name: str) -> DataFrame:
    """Every price with the metadata of its product. Both sides lie in the same buckets: no exchange."""
    prices, metadata = spark.table(f"{name}_prices"), spark.table(f"{name}_metadata")
    return prices.join(metadata.hint("merge"), KEYS, "left").drop("salt")
