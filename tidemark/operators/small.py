"""Joins against summaries whose size is checked before anything is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_SMALL_ROWS = 100_000
SALTS = 64


def collect_small(df: DataFrame, max_rows: int = MAX_SMALL_ROWS) -> DataFrame | None:
    """``df`` as a local relation if it has at most ``max_rows`` rows, else None."""
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows:
        return None
    return df.sparkSession.createDataFrame(table, schema=df.schema)


def localize(df: DataFrame, max_rows: int = MAX_SMALL_ROWS) -> DataFrame:
    """Like ``collect_small``, but an oversized relation simply stays distributed."""
    local = collect_small(df, max_rows)
    return df if local is None else local


def attach(
    df: DataFrame, summary: DataFrame, on: list[str], how: str = "left", max_rows: int = MAX_SMALL_ROWS
) -> DataFrame:
    """Put the columns of a per-group summary beside the rows of each group.

    A summary of checked size is broadcast, so the large side is not shuffled. A larger one is
    replicated over salts, so that no hot group ends up in a single task.
    """
    local = collect_small(summary, max_rows)
    if local is not None:
        return df.join(F.broadcast(local), on, how)
    return salted_join(df, summary, on, how)


def salted_join(
    df: DataFrame, summary: DataFrame, on: list[str], how: str = "left", salts: int = SALTS
) -> DataFrame:
    # The partition number tells copies of one row apart and stays the same when a task is repeated.
    salt = F.pmod(F.xxhash64(*df.columns) + F.spark_partition_id(), F.lit(salts))
    salted = df.withColumn("_salt", salt)
    every = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    copies = summary.withColumn("_salt", F.explode(every))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
