"""Connected components of a large graph by alternating star contractions; every round is a few joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b): the smallest node that it is connected with.

    Each round links the larger neighbours of a node to its smallest one, then the smaller ones among themselves;
    after about log(n) rounds every component is a star. The smallest neighbour of a node is combined before the
    shuffle, and a node with very many edges is split by adaptive joins. Edges with a null end are left out.
    """
    stars = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    stars, before = written(stars, "edges"), None
    while True:
        now = stars.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if now == before or now.n == 0:
            break
        before = now
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        stars = written(small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), "edges")
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
