"""Wide-row table: one key per product and time, text cells in column families.

Files are partitioned by a hash of the product and sorted by key, so that a read for one product opens
one partition and skips most row groups. Writes append versions; reads keep the last one of each key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import cleaning as c
from tidemark.operators.history import latest_version
from tidemark.schema import METADATA_CELLS, PRICE_CELLS

KEY_BUCKETS = 256

WIDE_DDL = (
    "row_key string, "
    f"price_cf struct<{', '.join(f'{x}: string' for x in PRICE_CELLS)}>, "
    f"metadata_cf struct<{', '.join(f'{x}: string' for x in METADATA_CELLS)}>, "
    "agg_cf map<string, string>, written_at timestamp, key_bucket int"
)


def key_bucket(product_id: Column, buckets: int = KEY_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(product_id), F.lit(buckets)).cast("int")


def create_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the table unless it exists."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({WIDE_DDL}) USING parquet PARTITIONED BY (key_bucket){place}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def encode_rows(df: DataFrame, written_at: Column | None = None, buckets: int = KEY_BUCKETS) -> DataFrame:
    """Observations as wide rows. Rows without a product id are refused by the caller (see ``writable``)."""
    return df.select(
        c.row_key("product_id", "scraped_at").alias("row_key"),
        F.struct(*[c.encode_cell(x).alias(x) for x in PRICE_CELLS]).alias("price_cf"),
        F.struct(*[c.encode_cell(x).alias(x) for x in METADATA_CELLS]).alias("metadata_cf"),
        F.lit(None).cast("map<string,string>").alias("agg_cf"),
        (F.current_timestamp() if written_at is None else written_at).alias("written_at"),
        key_bucket(F.col("product_id"), buckets).alias("key_bucket"),
    )


def writable(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a product id, rows without)."""
    named = F.coalesce(F.col("product_id") != "", F.lit(False))
    return df.where(named), df.where(~named)


def upsert_wide_row(
    df: DataFrame, path: str, written_at: Column | None = None, buckets: int = KEY_BUCKETS
) -> None:
    """Append the last version of each key of this batch.

    Rows are ordered by key within range partitions, so a product with very many rows is spread over
    several files.
    """
    rows = latest_version(encode_rows(writable(df)[0], written_at, buckets))
    (
        rows.repartitionByRange("key_bucket", "row_key")
        .sortWithinPartitions("key_bucket", "row_key")
        .write.mode("append")
        .partitionBy("key_bucket")
        .parquet(path)
    )


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WIDE_DDL).parquet(path)


def decode_wide_row(rows: DataFrame) -> DataFrame:
    """Cells as plain columns; price and rating as numbers, null where the text is none."""
    cells = rows.select("row_key", "price_cf.*", "metadata_cf.*")
    return cells.withColumn("price", c.to_number("price")).withColumn("rating", c.to_number("rating"))


def product_rows(rows: DataFrame, product_id: str, buckets: int = KEY_BUCKETS) -> DataFrame:
    """Range of keys of one product: ``id#`` <= key < ``id$``."""
    bucket = key_bucket(F.lit(product_id), buckets)
    in_range = (F.col("row_key") >= f"{product_id}#") & (F.col("row_key") < f"{product_id}$")
    return latest_version(rows.where((F.col("key_bucket") == bucket) & in_range))


def product_history(rows: DataFrame, product_id: str, limit: int = 100, buckets: int = KEY_BUCKETS) -> DataFrame:
    """Observations of a product, newest first."""
    return decode_wide_row(product_rows(rows, product_id, buckets).orderBy("row_key").limit(limit))


def latest_price(rows: DataFrame, product_id: str, buckets: int = KEY_BUCKETS) -> DataFrame:
    return product_history(rows, product_id, 1, buckets)


def scan_all(rows: DataFrame, limit: int = 1000) -> DataFrame:
    """First keys of the table.

    Starts jobs: each takes the smallest rows of every task, more of them until they hold enough different keys.
    Only rows up to the last of these keys are then shuffled to find the versions.
    """
    keys, take = rows.select("row_key"), limit
    while True:
        top = keys.orderBy("row_key").limit(take)
        found = top.agg(F.count("*").alias("n"), F.count_distinct("row_key").alias("keys"), F.max("row_key").alias("last")).first()
        if found.n < take or found.keys >= limit:
            break
        take *= 4
    if found.n == take:
        rows = rows.where(F.col("row_key") <= found.last)
    return decode_wide_row(latest_version(rows).orderBy("row_key").limit(limit))


def compact(rows: DataFrame, path: str) -> None:
    """Rewrite the table to ``path`` with one version per key."""
    (
        latest_version(rows)
        .repartitionByRange("key_bucket", "row_key")
        .sortWithinPartitions("key_bucket", "row_key")
        .write.mode("overwrite")
        .partitionBy("key_bucket")
        .parquet(path)
    )
