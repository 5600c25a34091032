"""Column layouts and fixed vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("availability", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("scraped_at", T.TimestampType()),
    ]
)

PRICE_COLUMNS = PRICE_SCHEMA.fieldNames()

# Required fields, in the order in which a missing one is reported.
REQUIRED_ITEM_FIELDS = ["product_id", "title", "price", "currency", "source", "url", "scraped_at"]
REQUIRED_PAYLOAD_FIELDS = ["product_id", "source", "url", "title", "currency"]

# Host spelling of a source -> short spelling.
SOURCE_BY_HOST = {
    "books.toscrape.com": "books_toscrape",
    "scrapeme.live": "scrapeme_live",
    "jumia.ma": "jumia_ma",
    "ultrapc.ma": "ultrapc_ma",
    "micromagma.ma": "micromagma_ma",
}
KNOWN_SOURCES = list(SOURCE_BY_HOST.values())
KNOWN_HOSTS = list(SOURCE_BY_HOST)
KNOWN_CURRENCIES = ["GBP", "EUR", "MAD", "USD"]

# CSS class word -> stars.
STARS_BY_WORD = {"One": 1.0, "Two": 2.0, "Three": 3.0, "Four": 4.0, "Five": 5.0}

# Columns by mart.
CURRENT_COLUMNS = [
    "product_id", "source", "title", "url", "price", "currency", "rating",
    "availability", "category", "scraped_at", "scraped_date",
]
HISTORY_COLUMNS = [
    "product_id", "source", "title", "url", "currency", "price", "prev_price",
    "price_change_pct", "price_change_abs", "prev_date", "scraped_date", "scraped_at",
]

# Column families of the wide-row table.
PRICE_CELLS = ["price", "currency", "availability"]
METADATA_CELLS = ["title", "source", "url", "category", "image_url", "rating", "scraped_at"]
