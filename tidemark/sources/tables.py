"""The given tables read as price observations.

``events`` and ``lineitem`` (with ``part``) take the role of scraped prices; shop pages and JSON records
are written out from their rows by Spark, so every query works on as much data as the tables hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.cleaning import lookup, strip
from tidemark.session import prepare

SOURCE_BY_EVENT = {
    "click": "books.toscrape.com",
    "error": "scrapeme.live",
    "purchase": "jumia.ma",
    "signup": "ultrapc.ma",
    "view": "micromagma.ma",
}
EVENT_TIE = ["event_id"]
LINE_TIE = ["l_orderkey", "l_linenumber", "l_suppkey"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def read_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as they are split; what follows deals them by its own keys."""
    return read_table(spark, sf_dir, "lineitem")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream; the pattern matches a single file as well as a folder."""
    schema = read_table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def raw_from_events(events: DataFrame) -> DataFrame:
    """One raw observation per event."""
    k, user = F.col("k"), F.col("user")
    typed = events.select(
        "*", F.get_json_object("props", "$.k").cast("int").alias("k"), F.col("user_id").cast("string").alias("user")
    )
    return typed.select(
        F.concat(F.lit("p"), user).alias("product_id"),
        lookup("event_type", SOURCE_BY_EVENT).alias("source"),
        F.concat(F.lit("https://shop.example.com/p/"), user).alias("url"),
        F.concat(F.lit("  Product "), user, F.lit(" \n")).alias("title"),
        F.col("value").alias("price"),
        F.when(F.col("event_type").isin("click", "error"), " gbp").otherwise("mad\t").alias("currency"),
        ((k % 51).cast("double") / 10).alias("rating"),
        F.when(k % 4 == 0, "").when(k % 4 == 1, " In stock").when(
            k % 4 == 2, F.concat(k.cast("string"), F.lit(" available"))
        ).alias("availability"),
        F.when(k % 13 == 0, " \n\t").otherwise(F.concat(F.lit("Cat "), (k % 6).cast("string"))).alias("category"),
        F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("https://img.example.com/"), user)).alias("image_url"),
        F.col("ts").cast("timestamp").alias("scraped_at"),
        "event_id",
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from_events(read_table(spark, sf_dir, "events"))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw observation per line item; brand is the source and type the category."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    lines = read_lines(spark, sf_dir)
    key = F.col("l_partkey").cast("string")
    return lines.join(part, lines["l_partkey"] == part["p_partkey"]).select(
        key.alias("product_id"),
        F.col("p_brand").alias("source"),
        F.concat(F.lit("https://shop.example.com/part/"), key).alias("url"),
        F.col("p_name").alias("title"),
        F.col("l_extendedprice").alias("price"),
        F.lit("USD").alias("currency"),
        (F.col("l_quantity") / 10).alias("rating"),
        F.lit("In stock").alias("availability"),
        F.col("p_type").alias("category"),
        F.lit(None).cast("string").alias("image_url"),
        F.col("l_shipdate").cast("timestamp").alias("scraped_at"),
        *LINE_TIE,
    )


def _iso(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def json_texts(events: DataFrame) -> DataFrame:
    """Each event as a JSON record ``value``.

    Some records are broken on purpose, some sent twice, some have their price as text, some no time, and some
    come a second time from another source.
    """
    raw = raw_from_events(events)
    e = F.col("event_id")
    record = F.struct(
        "product_id",
        "source",
        "url",
        F.when(e % 83 == 0, "").otherwise(strip("title")).alias("title"),
        F.when(e % 89 == 0, -F.col("price")).otherwise(F.col("price")).cast("string").alias("price"),
        F.upper(strip("currency")).alias("currency"),
        "rating",
        F.nullif("availability", F.lit("")).alias("availability"),
        F.lit("x").alias("unknown_field"),
        F.when(e % 101 != 0, _iso(F.col("scraped_at"))).alias("scraped_at"),
    )
    # A price goes out as a number but for one in seven, which stays text.
    text = F.when(e % 7 == 0, F.to_json(record)).otherwise(
        F.regexp_replace(F.to_json(record), r'"price":"([^"]*)"', r'"price":$1')
    )
    other = F.regexp_replace(text, r'"source":"[^"]*"', r'"source":"other.example"')
    value = F.when(e % 97 == 0, F.substring(text, 1, 30)).otherwise(text)
    copies = F.when(e % 10 == 0, F.array(value, value)).when((e % 13 == 0) & (e % 97 != 0), F.array(value, other)).otherwise(F.array(value))
    return raw.select(F.explode(copies).alias("value"))


def json_files(spark: SparkSession, sf_dir: str, folder: str, batches: int = 4) -> None:
    """The same records as text files, dealt one after another, so that a stream of files gets all times in any
    order and copies in another batch than the record."""
    # Dealt before the texts are built: the given table is one split.
    events = read_table(spark, sf_dir, "events").repartition(spark.sparkContext.defaultParallelism)
    json_texts(events).repartition(batches).write.text(folder)


def written_prices(lines: DataFrame) -> DataFrame:
    """Line items with their price as shops write it."""
    way, whole = F.col("l_orderkey") % 6, F.floor("l_extendedprice")
    text = F.col("_t")
    local = (
        F.when(way == 0, F.concat(F.translate(text, ",.", " ,"), F.lit(" DH")))
        .when(way == 1, F.concat(F.translate(text, ",.", ".,"), F.lit(" MAD")))
        .when(way == 2, text)
        .when(way == 3, F.concat(whole.cast("string"), F.lit(" DH")))
        .when(way == 4, F.format_number(whole, 0))
        .otherwise(F.concat(F.lit("Prix sur devis "), text))
    )
    return lines.withColumn("_t", F.format_number("l_extendedprice", 2)).select(
        "*", local.alias("local_text"), F.concat(F.lit("Â£"), text).alias("symbol_text")
    )


def _price_text(unit: str) -> Column:
    """'1 234,50 DH'."""
    return F.concat(F.translate(F.format_number("p_retailprice", 2), ",.", " ,"), F.lit(f" {unit}"))


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])


def _el(tag: str, *inside: str | Column, **attributes: str | Column) -> Column:
    """An element with its content; ``class_`` and ``data_src`` stand for class and data-src."""
    names = {k: k.rstrip("_").replace("_", "-") for k in attributes}
    marks = [_text(f' {names[k]}="', v, '"') for k, v in attributes.items()]
    return _text(f"<{tag}", *marks, ">", *inside, f"</{tag}>")


def _img(**attributes: str | Column) -> Column:
    return F.replace(_el("img", **attributes), F.lit("</img>"), F.lit(""))


def _page(*parts: str | Column) -> Column:
    return _el("html", _el("body", *parts))


FETCHED = "2024-02-01 12:00:00"


def _spread(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Hash partitions in a fixed number: pages are costly to read, so few bytes must not mean few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _as_pages(df: DataFrame) -> DataFrame:
    return df.select("url", "html", F.lit(FETCHED).cast("timestamp").alias("fetched_at"))


# The markup below has the classes that the layouts look for and nothing else of any shop.


def listing_pages(part: DataFrame) -> DataFrame:
    """Listing pages of twenty parts each in the one-step layout."""
    key, size = F.col("p_partkey"), F.col("p_size")
    card = _el(
        "article",
        _img(class_="img", data_src=_text("https://img.jumia.ma/", key, ".jpg")),
        F.when(size % 5 == 0, _el("div", "none left", class_="s-info")).otherwise(""),
        _el("div", _el("div", style=_text("width:", size * 2, "%")), class_="stars"),
        _el("h3", " ", F.col("p_name"), class_="name"),
        _el("a", "part ", key, class_="core", href=_text("/item-", key, ".html")),
        _el("div", _price_text("DH"), class_="prc"),
        class_="prd",
    )
    blocks = part.withColumn("kind", F.lower("p_type")).withColumn("block", F.floor(key / 20))
    pages = _spread(blocks, "kind", "block").groupBy("kind", "block").agg(
        F.concat_ws("\n", F.collect_list(card)).alias("cards")
    )
    return _as_pages(pages.withColumn("url", _text("https://www.jumia.ma/pc-", F.col("kind"), "/")).withColumn("html", _page(F.col("cards"))))


def _trail(*labels: str | Column) -> Column:
    return _el("nav", *[_el("li", _el("span", x)) for x in labels], class_="breadcrumb")


def shop_pages(part: DataFrame) -> DataFrame:
    """Listing pages of twenty parts and a detail page for most parts in the two-step layout."""
    key = F.col("p_partkey")
    url = _text("https://www.ultrapc.ma/parts/", key, ".html")
    card = _el(
        "article",
        F.when(key % 3 == 0, _el("span", "gone", class_="product-unavailable")).otherwise(""),
        _el("span", _price_text("MAD"), class_="price"),
        _img(class_="img-fluid", src=_text("/img/", key, ".jpg")),
        _el("h2", _el("a", "\n ", F.col("p_name"), "\n", href=url), class_="product-title"),
        class_="product-miniature",
    )
    listing = (
        _spread(part.withColumn("block", F.floor(key / 20)), "block")
        .groupBy("block")
        .agg(F.concat_ws("\n", F.collect_list(card)).alias("cards"))
        .withColumn("url", _text("https://www.ultrapc.ma/19-laptops?page=", F.col("block")))
        .withColumn("html", _page(_trail("All parts", "Laptops"), F.col("cards")))
    )
    price = F.when(key % 2 == 0, _price_text("MAD")).otherwise("Prix sur devis")
    detail = _spread(part.where(key % 7 != 0), "p_partkey").withColumn("url", url).withColumn(
        "html",
        _page(
            F.when(key % 4 == 0, _img(class_="js-qv-product-cover", src=_text("/img/hi-", key, ".jpg"))).otherwise(""),
            _trail("All parts", _text(" ", F.col("p_type"), " "), "x"),
            F.when(key % 5 == 0, _el("span", "Rupture", class_="label-out-of-stock")).otherwise(""),
            _el("div", _el("span", price, class_="price"), class_="product-prices"),
        ),
    )
    return _as_pages(listing.select("url", "html")).unionByName(_as_pages(detail))


def book_pages(part: DataFrame) -> DataFrame:
    """Detail pages in the book shop's layout."""
    key = F.col("p_partkey")
    words = F.array(*[F.lit(x) for x in ("One", "Two", "Three", "Four", "Five")])
    stars = F.element_at(words, (F.col("p_size") % 5 + 1).cast("int"))
    html = _page(
        _el("div", _img(src=_text("../../media/", key, ".jpg")), id="product_gallery"),
        _el("div", _el("h1", F.col("p_name")), _el("p", " In stock\n", class_="availability"), class_="product_main"),
        _el("p", class_=_text("star-rating ", stars)),
        _el("p", "£", F.format_number("p_retailprice", 2), class_="price_color"),
        _el("ul", *[_el("li", _el("a", x)) for x in ("Start", "Parts", _text(" ", F.col("p_type")))], class_="breadcrumb"),
    )
    url = _text("https://books.toscrape.com/catalogue/b_", key, "/index.html")
    return _as_pages(_spread(part, "p_partkey").withColumn("url", url).withColumn("html", html))


def shop_detail_pages(part: DataFrame) -> DataFrame:
    """Detail pages in the single-product shop's layout."""
    key = F.col("p_partkey")
    price = _el("bdi", "£", F.format_number("p_retailprice", 2))
    html = _page(
        _el("div", _el("a", "picture", href=_text("https://scrapeme.live/f/", key, ".png")), class_="woocommerce-product-gallery__image"),
        _el("div", _el("i", class_="star-rating", aria_label=_text(F.col("p_size") / 10, " out of 5")), class_="woocommerce-product-rating"),
        _el("span", _el("a", F.col("p_type")), class_="posted_in"),
        _el("p", F.when(key % 2 == 0, "7 in stock").otherwise("Out of stock"), class_="stock"),
        _el("p", _el("span", price, class_="woocommerce-Price-amount"), class_="price"),
        _el("h1", F.col("p_name"), class_="product_title"),
    )
    url = _text("https://scrapeme.live/shop/", key, "/")
    return _as_pages(_spread(part, "p_partkey").withColumn("url", url).withColumn("html", html))
