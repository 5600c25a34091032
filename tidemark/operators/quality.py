"""Data-quality checks and expectations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cleaning as c
from tidemark.operators.distribution import count_values
from tidemark.operators.small import localize
from tidemark.operators.staging import as_instant, as_number
from tidemark.schema import KNOWN_SOURCES

# Columns every data set must have, in reporting order.
REQUIRED_COLUMNS = ["product_id", "price", "source", "title", "scraped_at"]
FIRST_DAY = "2020-01-01"
CHECK_SCHEMA = "check string, passed boolean, detail string"


def unknown_sources(df: DataFrame, known: list[str] | None = None) -> DataFrame:
    """Observed sources that are not known, all of them."""
    return (
        df.select("source").where(F.col("source").isNotNull() & ~F.col("source").isin(known or KNOWN_SOURCES)).distinct()
    )


def _instant(as_of: dt.datetime | str | Column | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp")


def _number(df: DataFrame, col: str) -> Column:
    """The value of a column as a number; NaN is none."""
    number = as_number(df, col)
    return F.when(~F.isnan(number), number)


def run_checks(
    df: DataFrame, as_of: dt.datetime | str | Column | None = None, known: list[str] | None = None
) -> DataFrame:
    """The suite as (check, passed, detail), in a fixed order.

    One aggregate pass covers all scalar checks, one the outlier fence and one the sources. Numbers and times are
    parsed only where a column is text. The details name the first NAMED unknown and rare sources and count
    the others; ``unknown_sources`` and ``rare_sources`` are the relations with all of them.
    """
    spark = df.sparkSession
    known = known or KNOWN_SOURCES
    has = [x in df.columns for x in REQUIRED_COLUMNS]
    out: list[tuple] = [
        (f"column '{x}' exists", there, "" if there else "missing") for x, there in zip(REQUIRED_COLUMNS, has)
    ]

    def table() -> DataFrame:
        return spark.createDataFrame(out, CHECK_SCHEMA)

    cols = set(df.columns)
    if "price" in cols:
        df = df.withColumn("_price", _number(df, "price"))
    if "scraped_at" in cols:
        df = df.withColumn("_at", as_instant(df, "scraped_at"))
    if "rating" in cols:
        df = df.withColumn("_rating", _number(df, "rating"))
    bad = lambda cond: F.count_if(cond)
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [bad(F.col(x).isNull()).alias(f"null_{x}") for x in ("product_id", "price", "source", "currency") if x in cols]
    if "price" in cols:
        aggs += [
            F.count("_price").alias("prices"), bad(F.col("_price") <= 0).alias("not_positive"),
            F.max("_price").alias("max_price"), F.min("_price").alias("min_price"),
        ]
    if "product_id" in cols:
        aggs += [F.count_distinct("product_id").alias("products")]
    if "scraped_at" in cols:
        now = _instant(as_of)
        aggs += [
            F.count("_at").alias("times"), bad(F.col("_at") > now).alias("future"),
            bad(F.col("_at") < F.lit(FIRST_DAY).cast("timestamp")).alias("ancient"),
        ]
    if "title" in cols:
        aggs += [bad(F.col("title").isNull() | (c.strip(F.col("title").cast("string")) == "")).alias("untitled")]
    if "rating" in cols:
        aggs += [F.count("_rating").alias("ratings"), bad(~F.col("_rating").between(0, 5)).alias("bad_ratings")]
    row = df.agg(*aggs).first().asDict()
    total = row["rows"]
    if total == 0:
        out.append(("dataset is non-empty", False, "0 rows loaded"))
        return table()

    def pct(part: int, whole: int = total) -> float:
        return part / whole * 100 if whole else 0.0

    for x in ("product_id", "price", "source"):
        if x in cols:
            share = pct(row[f"null_{x}"])
            out.append((f"'{x}' null rate < 1%", share < 1.0, f"{share:.1f}% nulls"))
    if "price" in cols:
        n, low, high = row["prices"], row["min_price"], row["max_price"]
        out += [
            ("price column is numeric", n > 0, "0 non-numeric"),
            ("all prices > 0", row["not_positive"] == 0, f"{row['not_positive']} zero/negative"),
            ("price max < 1_000_000", n > 0 and high < 1_000_000, f"max={high:.2f}" if n else "max=nan"),
            ("price min >= 0.01", n > 0 and low >= 0.01, f"min={low:.4f}" if n else "min=nan"),
        ]
        far = pct(_far_rows(df, "_price", 3.0), n) if n else float("nan")
        out.append(("extreme price outliers < 5%", far < 5.0, f"{far:.1f}% extreme outliers"))
    if "source" in cols:
        out += _source_checks(df, known)
    if "product_id" in cols:
        distinct = row["products"] + (1 if row["null_product_id"] else 0)
        repeats = pct(total - distinct)
        out += [
            ("product_id duplicate rate < 80%", repeats < 80.0, f"{repeats:.1f}% duplicates (expected for time-series)"),
            ("product_id not all null", row["null_product_id"] < total, ""),
        ]
    if "scraped_at" in cols:
        missing, ancient = pct(total - row["times"]), pct(row["ancient"], row["times"])
        out += [
            ("scraped_at null rate < 5%", missing < 5.0, f"{missing:.1f}% nulls"),
            ("no future scraped_at values", row["future"] == 0, f"{row['future']} future rows"),
            (f"scraped_at >= {FIRST_DAY}", row["times"] > 0 and ancient == 0, f"{ancient:.1f}% pre-2020"),
        ]
    if "title" in cols:
        empty = pct(row["untitled"])
        out.append(("title empty rate < 5%", empty < 5.0, f"{empty:.1f}% empty"))
    if "currency" in cols:
        share = pct(row["null_currency"])
        out.append(("currency null rate < 10%", share < 10.0, f"{share:.1f}% nulls"))
    if row.get("ratings"):
        out.append(("rating in [0, 5]", row["bad_ratings"] == 0, f"out-of-range: {row['bad_ratings']}"))
    return table()


def _far_rows(df: DataFrame, col: str, k: float) -> int:
    """Rows outside the quartile fences, counted over distinct values."""
    counted = count_values(df, [], col)
    quarts = counted.quantiles({"q25": 0.25, "q75": 0.75}).first()
    reach = k * (quarts["q75"] - quarts["q25"])
    outside = ~F.col(col).between(quarts["q25"] - reach, quarts["q75"] + reach)
    return counted.table.where(outside).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def rare_sources(df: DataFrame, least: int = 5) -> DataFrame:
    """(source, n) of observed sources with fewer than ``least`` records, all of them."""
    counts = df.where(F.col("source").isNotNull()).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") < least)


#: Sources that a detail names.
NAMED = 100


def _source_checks(df: DataFrame, known: list[str]) -> list[tuple]:
    counts = localize(df.where(F.col("source").isNotNull()).groupBy("source").agg(F.count(F.lit(1)).alias("n")))
    strange, rare = ~F.col("source").isin(known), F.col("n") < 5
    found = counts.agg(F.count_if(strange).alias("strange"), F.count_if(rare).alias("rare")).first()

    def some(cond: Column, there: int) -> tuple[list, str]:
        rows = counts.where(cond).orderBy("source").limit(NAMED).collect() if there else []
        return rows, f" and {there - NAMED} more" if there > NAMED else ""

    names, more = some(strange, found["strange"])
    unknown = ", ".join(repr(r["source"]) for r in names)
    few, others = some(rare, found["rare"])
    return [
        ("all sources are known", found["strange"] == 0, f"unknown: {{{unknown}}}{more}" if names else ""),
        ("each source has >= 5 records", found["rare"] == 0, f"low-count sources: { {r['source']: r['n'] for r in few} }{others}"),
    ]


def quality_score(checks: DataFrame) -> DataFrame:
    passed = F.count_if("passed")
    return checks.agg(
        F.count(F.lit(1)).alias("checks"),
        passed.alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.round(passed / F.greatest(F.count(F.lit(1)), F.lit(1)) * 100, 1).alias("score_pct"),
    )


class QualityError(RuntimeError):
    """Raised by the gate when a check failed."""


def fail_on_error(checks: DataFrame) -> DataFrame:
    failed = [r["check"] for r in checks.where(~F.col("passed")).collect()]
    if failed:
        raise QualityError("; ".join(failed))
    return checks


# Expectations return the offending rows, so an empty result means the expectation holds.


def expect_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.where(c.any_of([F.col(x).isNull() for x in cols]))


def expect_unique(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def expect_in(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.where(~F.col(col).isin(values))


def expect_non_negative(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col) < 0)


def expect_not_future(
    df: DataFrame, col: str = "scraped_at", as_of: dt.datetime | str | Column | None = None, minutes: int = 5
) -> DataFrame:
    return df.where(F.col(col) > _instant(as_of) + F.make_dt_interval(mins=F.lit(minutes)))


def expect_change_bounded(history: DataFrame, low: float = -100.0, high: float = 500.0) -> DataFrame:
    pct = F.col("price_change_pct")
    return history.where(F.col("prev_price").isNotNull() & ((pct > high) | (pct < low)))


def count_failures(expectations: dict[str, DataFrame]) -> DataFrame:
    """Number of offending rows of each expectation, in one job over all of them."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("expectation"), "failures")
        for name, df in expectations.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def relation_failures(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Offending rows of each rule, a condition that only offending rows meet, from one pass over ``df``."""
    counts = df.agg(*[F.count_if(F.coalesce(cond, F.lit(False))).alias(f"c{i}") for i, cond in enumerate(rules.values())])
    pairs = [F.struct(F.lit(name).alias("expectation"), F.col(f"c{i}").alias("failures")) for i, name in enumerate(rules)]
    return counts.select(F.inline(F.array(*pairs)))


def mart_failures(staged: DataFrame, marts: dict[str, DataFrame], as_of=None) -> DataFrame:
    """Failures of the declared tests of the staging relation and of the marts: one pass over each relation, and one
    more that counts repeated products."""
    from tidemark.schema import KNOWN_CURRENCIES, KNOWN_HOSTS

    def missing(*cols: str) -> Column:
        return c.any_of([F.col(x).isNull() for x in cols])

    required = ["product_id", "source", "url", "title", "price", "currency", "scraped_at", "scraped_date"]
    late = F.col("scraped_at") > _instant(as_of) + F.make_dt_interval(mins=F.lit(5))
    change = F.col("price_change_pct")
    rules = {
        "staged": {
            **{f"staged {x} not null": missing(x) for x in required},
            "staged source accepted": ~F.col("source").isin(KNOWN_HOSTS),
            "staged currency accepted": ~F.col("currency").isin(KNOWN_CURRENCIES),
            "staged price non negative": F.col("price") < 0,
            "staged not in future": late,
        },
        "current_prices": {
            "current not null": missing("product_id", "price", "scraped_at"),
            "current price non negative": F.col("price") < 0,
        },
        "price_history": {
            "history not null": missing("product_id", "price", "scraped_date"),
            "history price non negative": F.col("price") < 0,
            "history change bounded": F.col("prev_price").isNotNull() & ((change > 500.0) | (change < -100.0)),
        },
        "price_stats": {
            "stats not null": missing("source", "currency", "product_count", "avg_price"),
            "stats average non negative": F.col("avg_price") < 0,
        },
        "price_alerts": {"alerts not null": missing("product_id", "price_change_pct")},
    }
    out = count_failures({"current product_id unique": expect_unique(marts["current_prices"], "product_id")})
    for name, own in rules.items():
        out = out.unionByName(relation_failures(staged if name == "staged" else marts[name], own))
    return out
