"""Topic source and sink. The connector package is not part of Spark itself: add it to the session."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import PRICE_COLUMNS
from tidemark.sources.files import JSON_TIME, parse_records

TOPIC = "price.raw"


def read_kafka(
    spark: SparkSession, servers: str, topic: str = TOPIC, max_per_trigger: int | None = None
) -> DataFrame:
    """Unparsed messages from the earliest offset on, at most ``max_per_trigger`` per micro-batch."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def end_offsets(start: dict[int, int], end: dict[int, int], limit: int) -> dict[int, int]:
    """Where each partition of a topic stops so that ``limit`` messages are read in all, or all there are if fewer.

    Partitions give equal shares; what a short one cannot give is shared among the others.
    """
    there = {p: max(0, end[p] - start.get(p, 0)) for p in end}
    taken, left = dict.fromkeys(there, 0), min(limit, sum(there.values()))
    open_ones = sorted(there, key=lambda p: (there[p], p))
    for k, p in enumerate(open_ones):
        # The shortest first: no later partition can give less than its equal share of what is left.
        taken[p] = min(there[p], left // (len(open_ones) - k) if k + 1 < len(open_ones) else left)
        left -= taken[p]
    return {p: start.get(p, 0) + taken[p] for p in there}


def read_limited(spark: SparkSession, servers: str, start: dict[int, int], end: dict[int, int], limit: int, topic: str = TOPIC) -> DataFrame:
    """A batch of exactly ``limit`` messages (or all, if fewer) between known offsets of a topic."""
    stops = end_offsets(start, end, limit)
    offsets = [json.dumps({topic: {str(p): x[p] for p in sorted(stops)}}) for x in ({p: start.get(p, 0) for p in stops}, stops)]
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.option("startingOffsets", offsets[0]).option("endingOffsets", offsets[1]).load()


def parse_messages(messages: DataFrame) -> DataFrame:
    return parse_records(messages.select(F.col("value").cast("string").alias("value")))


def to_messages(df: DataFrame, source: str | None = None) -> DataFrame:
    """(key, value): product id, else title, as the key and the record as JSON."""
    if source:
        df = df.where(F.col("source") == source)
    key = F.coalesce(F.nullif("product_id", F.lit("")), F.col("title"), F.lit(""))
    record = F.struct(*[x for x in PRICE_COLUMNS if x in df.columns])
    return df.select(F.nullif(key, F.lit("")).alias("key"), F.to_json(record, {"ignoreNullFields": "false", **JSON_TIME}).alias("value"))


def publish(df: DataFrame, servers: str, topic: str = TOPIC, source: str | None = None) -> None:
    (
        to_messages(df, source)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.linger.ms", "5")
        .option("topic", topic)
        .save()
    )
