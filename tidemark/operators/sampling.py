"""Bounded sample per group, exact also for hot groups and for many copies of one row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.small import attach

HASH_DIGITS = 13
LEVELS_PER_HALVING = 4


def sample_per_group(df: DataFrame, group: str, key: list[str], max_n: int = 5000, seed: int = 42) -> DataFrame:
    """The ``max_n`` rows of each group with the lowest hash of seed and key.

    A first pass counts rows by magnitude of the hash, so that the second one only moves the rows that
    can be chosen. Equal rows are counted before they are shuffled.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])
    draw = F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("long")
    level = F.floor(-F.log2((draw + 1) / F.lit(float(16**HASH_DIGITS))) * LEVELS_PER_HALVING).cast("int")
    rows = df.withColumn("_draw", draw).withColumn("_level", level)
    from_lowest = Window.partitionBy(group).orderBy(F.desc("_level")).rowsBetween(Window.unboundedPreceding, 0)
    needed = (
        rows.groupBy(group, "_level")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(from_lowest) - F.col("_n"))
        .where(F.col("_before") < max_n)
        .select(group, "_level")
    )
    kept = attach(rows, needed, [group, "_level"], how="inner").drop("_level")
    order = Window.partitionBy(group).orderBy("_draw", *df.columns).rowsBetween(Window.unboundedPreceding, 0)
    counted = kept.groupBy(*df.columns, "_draw").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(order) - F.col("_n")
    return (
        counted.withColumn("_take", F.least(F.col("_n"), F.lit(max_n) - before))
        .where(F.col("_take") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_take"))))
        .select(*df.columns)
    )
