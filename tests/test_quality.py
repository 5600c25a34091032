import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as q

NOW = "2024-06-01 00:00:00"


def rows(spark, n=20, **changes):
    df = spark.range(n).select(
        F.concat(F.lit("p"), "id").alias("product_id"), F.lit("jumia_ma").alias("source"), F.lit("t").alias("title"),
        (F.col("id") + 1.0).alias("price"), F.lit("MAD").alias("currency"), F.lit(4.0).alias("rating"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("scraped_at"),
    )
    return df.withColumns(changes)


def results(df, **kw):
    return {r.check: (r.passed, r.detail) for r in q.run_checks(df, as_of=NOW, **kw).collect()}


def test_clean_data_passes_23_checks(spark):
    got = results(rows(spark))
    assert len(got) == 23 and all(p for p, _ in got.values())
    score = q.quality_score(q.run_checks(rows(spark), as_of=NOW)).first()
    assert (score.checks, score.passed, score.failed, score.score_pct) == (23, 23, 0, 100.0)


@pytest.mark.parametrize(
    "column,value,check,detail",
    [
        ("product_id", "cast(null as string)", "product_id not all null", ""),
        ("price", "0.0D", "all prices > 0", "20 zero/negative"),
        ("price", "0.001D", "price min >= 0.01", "min=0.0010"),
        ("price", "2e6D", "price max < 1_000_000", "max=2000000.00"),
        ("source", "'x'", "all sources are known", "unknown: {'x'}"),
        ("product_id", "'same'", "product_id duplicate rate < 80%", "95.0% duplicates (expected for time-series)"),
        ("scraped_at", "timestamp'2025-01-01'", "no future scraped_at values", "20 future rows"),
        ("scraped_at", "timestamp'2019-01-01'", "scraped_at >= 2020-01-01", "100.0% pre-2020"),
        ("title", "'  '", "title empty rate < 5%", "100.0% empty"),
        ("currency", "cast(null as string)", "currency null rate < 10%", "100.0% nulls"),
        ("rating", "6.0D", "rating in [0, 5]", "out-of-range: 20"),
    ],
)
def test_each_check_can_fail(spark, column, value, check, detail):
    assert results(rows(spark, **{column: F.expr(value)}))[check] == (False, detail)


def test_outliers_and_rare_sources(spark):
    far = F.when(F.col("id") < 2, 900_000.0).otherwise(F.col("id") + 1.0)
    df = spark.range(20).select("id").withColumn("price", far)
    got = results(rows(spark).withColumn("id", F.lit(1)).join(df.select(F.concat(F.lit("p"), "id").alias("product_id"), F.col("price").alias("x")), "product_id").withColumn("price", F.col("x")))
    assert got["extreme price outliers < 5%"] == (False, "10.0% extreme outliers")
    rare = results(rows(spark).withColumn("source", F.when(F.col("product_id") == "p1", "ultrapc_ma").otherwise("jumia_ma")))
    assert rare["each source has >= 5 records"] == (False, "low-count sources: {'ultrapc_ma': 1}")


def test_missing_columns_and_empty_data(spark):
    got = results(rows(spark).drop("title", "rating"))
    assert got["column 'title' exists"] == (False, "missing") and "rating in [0, 5]" not in got
    empty = results(rows(spark, 0))
    assert len(empty) == 6 and empty["dataset is non-empty"] == (False, "0 rows loaded")


def test_gate(spark):
    good = q.run_checks(rows(spark), as_of=NOW)
    assert q.fail_on_error(good).count() == 23
    with pytest.raises(q.QualityError, match="all prices > 0"):
        q.fail_on_error(q.run_checks(rows(spark, price=F.lit(-1.0)), as_of=NOW))


def test_expectations(spark):
    df = rows(spark, 3)
    assert q.expect_unique(df, "source").first().n == 3 and q.expect_unique(df, "product_id").isEmpty()
    assert q.expect_in(df, "source", ["jumia_ma"]).isEmpty() and q.expect_in(df, "source", ["x"]).count() == 3
    assert q.expect_not_null(df, ["title"]).isEmpty()
    at = dt.datetime(2023, 12, 31, 23, 56)
    assert q.expect_not_future(df, as_of=at).isEmpty()
    assert q.expect_not_future(df, as_of="2023-12-31 23:54:00").count() == 3
    history = spark.createDataFrame([(1.0, 500.0), (1.0, 501.0), (1.0, -100.0), (None, 900.0), (1.0, None)], "prev_price double, price_change_pct double")
    assert [r[1] for r in q.expect_change_bounded(history).collect()] == [501.0]
