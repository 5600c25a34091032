"""Daily deduplication and change of price over time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import cleaning as c
from tidemark.operators.small import attach
from tidemark.session import stash


def newest_first(df: DataFrame, tie_break: list[str]) -> list[Column]:
    """Latest row first. Rows of equal time are ordered by ``tie_break``, or by all they contain."""
    if tie_break:
        return [F.desc("scraped_at"), *[F.desc(x) for x in tie_break]]
    return [F.desc("scraped_at"), *by_content(df, {"scraped_at"})]


def by_content(df: DataFrame, known: set[str]) -> list[Column]:
    """An order by every other column, so that only equal rows can change places; maps by their sorted entries."""
    out = []
    for field in df.schema.fields:
        if field.name not in known:
            x = F.col(f"`{field.name}`")
            out.append((F.array_sort(F.map_entries(x)) if field.dataType.typeName() == "map" else x).desc())
    return out


def dedupe_daily(df: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """Latest row of each product and day.

    The ``rn = 1`` limit is applied in every map task before the shuffle, so even a product that owns
    a large share of all rows sends at most one row per task and day.
    """
    w = Window.partitionBy("product_id", "scraped_date").orderBy(*newest_first(df, tie_break or []))
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1).drop("rn")


def latest_version(df: DataFrame, key: str = "row_key", written: str = "written_at") -> DataFrame:
    """Keep one version, the last written, of every key; of versions written together the greatest by content."""
    w = Window.partitionBy(key).orderBy(F.desc(written), *by_content(df, {key, written}))
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1).drop("rn")


def price_changes(deduped: DataFrame) -> DataFrame:
    """Previous price and date of the product, and the change against it.

    Input has one row per product and day, so a window holds at most as many rows as there are days.
    """
    w = Window.partitionBy("product_id").orderBy("scraped_at")
    return (
        deduped.withColumn("prev_price", F.lag("price").over(w))
        .withColumn("prev_date", F.lag("scraped_date").over(w))
        .withColumn("price_change_pct", c.price_change_pct("price", "prev_price"))
        .withColumn("price_change_abs", c.price_change_abs("price", "prev_price"))
    )


def lag_price(df: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """``prev_price`` over all rows of a product in the given order, without daily deduplication.

    A segmented scan: rows are dealt by ranges of (product, order), so that a product with very many rows, be they of
    one day, lies in several partitions; each partition is walked once in order, and its first row takes the price of
    the last row of the partition before, if that is of the same product. Copies of a row that fall into two
    partitions are neighbours there too. A null product_id is a product of its own. Starts jobs: the ranges come from
    a sample of the rows, and the walked rows are written, as the borders are read from them.
    """
    # Rows that are equal in all of the order may be split between partitions as well.
    spread = df.withColumn("_spread", F.monotonically_increasing_id())
    keys = ["product_id", *order, "_spread"]
    dealt = spread.repartitionByRange(*([partitions] if partitions else []), *keys)
    marks = [T.StructField("prev_price", df.schema["price"].dataType), T.StructField("_part", T.IntegerType()), T.StructField("_edge", T.IntegerType())]
    product, price = df.columns.index("product_id"), df.columns.index("price")
    walked = dealt.sortWithinPartitions(*keys).drop("_spread").mapInArrow(
        lambda batches: _walk(batches, product, price), T.StructType([*df.schema.fields, *marks])
    )
    rows = stash(walked, "lag")
    # Two rows a partition: its first and its last; partitions without rows leave none.
    lasts = rows.where(F.col("_edge").bitwiseAND(F.lit(LAST)) != 0).select("_part", F.struct("product_id", "price").alias("_last"))
    before = lasts.select("_part", F.lag("_last").over(Window.orderBy("_part")).alias("_before"))
    carried = (F.col("_edge").bitwiseAND(F.lit(FIRST)) != 0) & F.col("_before").isNotNull() & F.col("_before.product_id").eqNullSafe(F.col("product_id"))
    return attach(rows, before, ["_part"]).select(
        *df.columns, F.when(carried, F.col("_before.price")).otherwise(F.col("prev_price")).alias("prev_price")
    )


FIRST, LAST = 1, 2


def _walk(batches: Iterator[pa.RecordBatch], product: int, price: int) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition with the price before, the partition's number, and marks of its first and last row."""
    part = TaskContext.get().partitionId()
    held, edge = None, FIRST

    def marked(batch: pa.RecordBatch, before: pa.RecordBatch | None, first: int, last: int) -> pa.RecordBatch:
        n = batch.num_rows
        prior = [pa.concat_arrays([before.column(c).slice(before.num_rows - 1) if before is not None else pa.nulls(1, batch.column(c).type), batch.column(c).slice(0, n - 1)]) for c in (product, price)]
        now = batch.column(product)
        same = pc.or_(pc.fill_null(pc.equal(now, prior[0]), False), pc.and_(pc.is_null(now), pc.is_null(prior[0])))
        edges = np.zeros(n, np.int32)
        edges[0] |= first
        edges[-1] |= last
        previous = pc.if_else(same, prior[1], pa.nulls(n, prior[1].type))
        if first:  # nothing is known yet of the row before
            previous = pa.concat_arrays([pa.nulls(1, previous.type), previous.slice(1)])
        columns = [*batch.columns, previous, pa.array(np.full(n, part, np.int32)), pa.array(edges)]
        return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "prev_price", "_part", "_edge"])

    # A batch is given out when the next has come, as only then it is known not to hold the last row.
    older = None
    for batch in batches:
        if batch.num_rows:
            if held is not None:
                yield marked(held, older, edge, 0)
                edge = 0
            older, held = held, batch
    if held is not None:
        yield marked(held, older, edge, LAST)


def latest_row(df: DataFrame, keys: list[str], tie_break: list[str] | None = None) -> DataFrame:
    """Whole row of the latest time by key (first limited in each map task, like ``dedupe_daily``)."""
    w = Window.partitionBy(*keys).orderBy(*newest_first(df, tie_break or []))
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1).drop("rn")


def last_non_null(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last value that is not null of every column by key, partially combined before the shuffle."""
    others = [x for x in df.columns if x not in keys]
    at = F.struct(*order)
    return df.groupBy(*keys).agg(
        *[F.max_by(x, F.when(F.col(x).isNotNull(), at)).alias(x) for x in others]
    ).select(*df.columns)
