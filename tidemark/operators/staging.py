"""Typing, defaulting and validating raw observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cleaning as c
from tidemark.schema import PRICE_SCHEMA, REQUIRED_ITEM_FIELDS, REQUIRED_PAYLOAD_FIELDS


def conform(df: DataFrame, default_currency: str = "GBP") -> DataFrame:
    """Add the columns a reader may miss and clean the ones it has."""
    has = set(df.columns)
    if "source" not in has:
        df = df.withColumn("source", F.col("spider") if "spider" in has else F.lit("unknown"))
    df = df.withColumn("source", c.normalize_source("source")).withColumn("price", c.to_number("price"))
    if "scraped_at" in has:
        df = df.withColumn("scraped_at", as_instant(df, "scraped_at"))
        df = df.withColumn("scraped_date", F.to_date("scraped_at"))
    if "availability" in has:
        df = df.withColumn("availability", c.normalize_availability("availability"))
    if "product_id" not in has:
        title = F.col("title") if "title" in has else F.lit("")
        df = df.withColumn("product_id", c.surrogate_product_id(title, F.col("source")))
    if "title" not in has:
        df = df.withColumn("title", F.col("product_id"))
    if "currency" not in has:
        df = df.withColumn("currency", F.lit(default_currency))
    if "category" not in has:
        df = df.withColumn("category", F.lit("Unknown"))
    return df


def stage_prices(raw: DataFrame, min_price: float = 0.0) -> DataFrame:
    """Typed, trimmed and defaulted observations; further columns of ``raw`` are passed on."""
    at = as_instant(raw, "scraped_at")
    extra = [x for x in raw.columns if x not in {*PRICE_SCHEMA.fieldNames(), "scraped_date"}]
    return (
        raw.where(F.col("product_id").isNotNull() & F.col("source").isNotNull())
        .select(
            "product_id",
            "source",
            "url",
            c.strip("title").alias("title"),
            as_number(raw, "price").alias("price"),
            F.upper(c.strip("currency")).alias("currency"),
            as_number(raw, "rating").alias("rating"),
            F.coalesce(c.blank_to_null(c.strip("availability")), F.lit("Unknown")).alias("availability"),
            c.blank_to_null(c.strip("category")).alias("category"),
            c.blank_to_null("image_url").alias("image_url"),
            at.alias("scraped_at"),
            F.to_date(at).alias("scraped_date"),
            *extra,
        )
        .where((F.col("price") >= min_price) & ~F.isnan("price"))
    )


def _is_text(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.simpleString() == "string"


def as_number(df: DataFrame, col: str) -> Column:
    """A numeric column stays bare, so that a filter on it reaches the scan."""
    return c.to_number(col) if _is_text(df, col) else F.col(col).cast("double")


def as_instant(df: DataFrame, col: str) -> Column:
    """A time column as instants; only text has to be parsed."""
    return c.to_utc(col) if _is_text(df, col) else F.col(col).cast("timestamp")


def shift_fields(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Keep and rename the listed fields (target: source name) and drop all others."""
    return df.select(*[F.col(src).alias(dst) for dst, src in spec.items()])


def default_fields(df: DataFrame, spec: dict[str, object]) -> DataFrame:
    """Give absent or null fields a value; a null default only makes sure the field exists.

    A text default is for text: a null time or number stays null.
    """
    for name, value in spec.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value).cast("double") if value is None else F.lit(value))
        elif value is not None and (_is_text(df, name) or not isinstance(value, str)):
            df = df.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return df


# Defaults of the stream route and of the ingest payload.
STREAM_DEFAULTS = {
    "pipeline": "nifi-streaming",
    "availability": "Unknown",
    "category": "",
    "image_url": "",
    "rating": None,
}
PAYLOAD_DEFAULTS = {
    "rating": None,
    "availability": "Unknown",
    "category": "",
    "image_url": "",
    "scraped_at": "",
    "pipeline": "unknown",
}


def _missing(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(True)
    blank = F.col(name) == "" if _is_text(df, name) else F.lit(False)
    return F.col(name).isNull() | blank


def reject_reason(df: DataFrame, required: list[str] | None = None) -> Column:
    """Why a row is refused, null for a valid one. Earlier rules win.

    Text in a price column is refused even if it reads as a number: only typed prices count.
    """
    checks = [F.when(_missing(df, f), f"missing {f}") for f in required or REQUIRED_ITEM_FIELDS]
    if "price" in df.columns and _is_text(df, "price"):
        checks.append(F.when(F.col("price").isNotNull(), "price not numeric"))
    elif "price" in df.columns:
        checks.append(F.when(F.col("price") < 0, "negative price"))
    return F.coalesce(*checks)


def with_reason(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    return df.withColumn("reject_reason", reject_reason(df, required))


def validate_items(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, refused rows with ``reject_reason``)."""
    marked = with_reason(df)
    return (
        marked.where(F.col("reject_reason").isNull()).drop("reject_reason"),
        marked.where(F.col("reject_reason").isNotNull()),
    )


def validate_payload(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ingest service's rules: texts of at least one character, price present and >= 0."""
    marked = with_reason(df, [*REQUIRED_PAYLOAD_FIELDS, "price"])
    return (
        default_fields(marked.where(F.col("reject_reason").isNull()).drop("reject_reason"), PAYLOAD_DEFAULTS),
        marked.where(F.col("reject_reason").isNotNull()),
    )


def sellable(df: DataFrame) -> DataFrame:
    """Drop listings without a title or with a zero price."""
    return df.where((F.col("title") != "") & (F.col("price") != 0))


def non_negative_price(df: DataFrame) -> DataFrame:
    return df.where(F.col("price") >= 0)


def clean_live(raw: DataFrame) -> DataFrame:
    """What a reader of raw records shows: conformed rows that have a price of at least zero."""
    return non_negative_price(conform(raw))


def positive_price(df: DataFrame) -> DataFrame:
    return df.where(F.col("price") > 0)
