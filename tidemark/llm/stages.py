"""The stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and works on all rows it is given.

Documents may have null texts, sources and labels, and columns beside those of the table. All but the last stage
return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, jaccard_join, mixing, quality, token_codes
from tidemark.llm.common import ready, table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.3; the classifier learns from all ``labels`` of the given documents."""
    ready(spark)
    stats = written(quality.document_statistics(docs), "quality-stats")
    model = quality.train(stats, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model, "_score", quality.ACCEPT).drop("_score")


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each group that hangs together by near-duplicate links; one without doc_id comes last.

    Every row is a document of its own under a key that is given here, so that texts under one doc_id, or under none, are
    told apart: another text of a doc_id stays, and of equal rows one stays.
    """
    ready(spark)
    keyed = written(docs.withColumn("_key", F.monotonically_increasing_id()), "keyed")
    groups = jaccard_join.near_duplicates(keyed.select(F.col("_key").alias("doc_id"), "text"))
    met = written(groups.filter("links > 0").select(F.col("doc_id").alias("_key"), "class_id"), "near-duplicates")
    # The same plan at every size: rows of groups are never broadcast.
    named = keyed.select("_key", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key").alias("_place")).join(met.hint("merge"), "_key")
    stays = named.groupBy("class_id").agg(F.min("_place").alias("_first"))
    others = met.join(stays.select(F.col("_first._key").alias("_key")).hint("merge"), "_key", "left_anti")
    return keyed.join(written(others, "near-duplicates").hint("merge"), "_key", "left_anti").select(docs.columns)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage. Rows pass through in place: no shuffle."""
    ready(spark)
    return decontamination.without_passages(docs, table(spark, sf_dir, "benchmark"))


MIXED = ("size", "source_size", "target", "copies", "copy")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says, with the columns it had, those named like the mix's own included.

    Rows without a doc_id draw by their text.
    """
    ready(spark)
    own = {c: f"_given_{c}" for c in docs.columns if c in MIXED}
    mixed = mixing.emit_copies(mixing.mix(docs.withColumnsRenamed(own)))
    return mixed.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all rows in ascending doc_id order; returns what is read back from them (copies one after another).

    Rows without a doc_id lie in files of their own behind the others, and come back without one.
    """
    ready(spark)
    manifest = token_codes.write_token_files(docs, token_codes.token_folder(spark))
    nameless = docs.filter("doc_id IS NULL").withColumn("doc_id", F.monotonically_increasing_id())
    behind = token_codes.write_token_files(nameless, token_codes.token_folder(spark))
    before = manifest.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n")).first().n
    rest = token_codes.read_digests(behind).withColumn("doc_id", F.lit(None).cast("long")).withColumn("start", F.col("start") + before)
    return token_codes.read_digests(manifest).unionByName(rest)
