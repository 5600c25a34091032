"""Product rows from stored shop pages.

Python only picks the marked-up texts out of each page. Everything after that - prices, ratings,
categories, ids, filters, the merge of listing and detail pages - are column expressions and joins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cleaning as c
from tidemark.functions import parsing as p
from tidemark.schema import PRICE_COLUMNS
from tidemark.session import stash

RAW_FIELDS = (
    "site string, url string, kind string, href string, title string, price_text string, rating_text string, "
    "stock_text string, out_marked boolean, crumbs array<string>, page_category string, image_url string, "
    "scraped_at timestamp"
)

# CSS selectors of the shop layouts. "@x" takes attribute x, otherwise the text is taken;
# the first candidate with content wins.
SHOP_LISTING = {
    "card": ["article.product-miniature", "div.product-container", "li.ajax_block_product"],
    "title": ["h2.product-title a", "h3.product-title a", "p.product-title a", "a.product_name"],
    "href": ["h2.product-title a@href", "h3.product-title a@href", "a.product_img_link@href"],
    "price_text": ["span.price", "span.product-price", "div.price span"],
    "image": ["img.img-fluid@src", "img@data-src", "img@src"],
    "out": ["span.product-unavailable", ".out_of_stock"],
    "page_category": ["nav.breadcrumb li:last-child span, ol.breadcrumb li:last-child"],
}
SHOP_DETAIL = {
    "present": ["span.current-price", "div.product-prices", "span#our_price_display", "img.js-qv-product-cover", "img#bigpic"],
    "price_text": ["span.current-price span", "div.product-prices span.price", "span#our_price_display"],
    "crumbs": "nav.breadcrumb li span, ol.breadcrumb li span, div#nav-breadcrumb a",
    "out": ["span.label-out-of-stock", ".out_of_stock"],
    "out_word": "rupture",
    "image": ["img.js-qv-product-cover@src, img#bigpic@src"],
}
LAYOUTS = {
    "books.toscrape.com": {
        "detail": {
            "present": ["div.product_main"],
            "title": ["div.product_main h1"],
            "price_text": ["p.price_color"],
            "rating_text": ["p.star-rating@class"],
            "stock_all": "p.availability",
            "crumbs": "ul.breadcrumb li a",
            "image": ["div#product_gallery img@src", "div.item.active img@src"],
        }
    },
    "scrapeme.live": {
        "detail": {
            "present": ["h1.product_title"],
            "title": ["h1.product_title"],
            "price_text": [
                "p.price span.woocommerce-Price-amount bdi",
                "p.price ins span.woocommerce-Price-amount bdi",
            ],
            "rating_text": ["div.woocommerce-product-rating .star-rating@aria-label"],
            "stock_text": ["p.stock"],
            "page_category": ["span.posted_in a"],
            "image": ["div.woocommerce-product-gallery__image a@href", "div.woocommerce-product-gallery img@src"],
        }
    },
    "jumia.ma": {
        "listing": {
            "card": ["article.prd"],
            "title": ["h3.name"],
            "href": ["a.core@href"],
            "price_text": ["div.prc"],
            "rating_text": ["div.stars > div@style"],
            "image": ["img.img@data-src", "img.img@src"],
            "out": ["div.s-info"],
            "image_absolute": False,
        }
    },
    "ultrapc.ma": {"listing": SHOP_LISTING, "detail": SHOP_DETAIL},
    "micromagma.ma": {"listing": SHOP_LISTING, "detail": SHOP_DETAIL},
}
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Node:
    __slots__ = ("tag", "attrs", "classes", "parent", "nodes", "texts", "found")

    def __init__(self, tag: str, attrs: dict, parent: _Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.classes = frozenset(attrs.get("class", "").split())
        self.nodes: list[_Node] = []
        self.texts: list[str] = []
        self.found: list[_Node] | None = None

    def all(self) -> list[_Node]:
        """This node and all below it in document order, listed once the page is complete."""
        if self.found is None:
            self.found, stack = [], [self]
            while stack:
                node = stack.pop()
                self.found.append(node)
                stack.extend(reversed(node.nodes))
        return self.found


class _Page(HTMLParser):
    """Element tree of a page; unclosed elements end with their parent."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", {}, None)
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag == "li" and self.at.tag == "li":
            self.at = self.at.parent
        node = _Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.nodes.append(node)
        if tag not in VOID_TAGS:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.nodes.append(_Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.texts.append(data)


@lru_cache(maxsize=256)
def _selector(text: str) -> tuple:
    """Alternatives of (steps, attribute); a step is (direct child?, tag, id, classes, last child?)."""
    out = []
    for part in text.split(","):
        path, _, attr = part.strip().partition("@")
        steps, direct = [], False
        for word in path.split():
            if word == ">":
                direct = True
                continue
            last = word.endswith(":last-child")
            word = word.removesuffix(":last-child")
            tag = re.match(r"[\w-]*", word).group()
            ids = re.findall(r"#([\w-]+)", word)
            steps.append((direct, tag, ids, frozenset(re.findall(r"\.([\w-]+)", word)), last))
            direct = False
        out.append((tuple(steps), attr))
    return tuple(out)


def _fits(node: _Node, step: tuple) -> bool:
    _, tag, ids, classes, last = step
    if (tag and node.tag != tag) or (ids and node.attrs.get("id") != ids[0]):
        return False
    if not classes <= node.classes:
        return False
    return not last or (node.parent is not None and node.parent.nodes[-1] is node)


def _matches(node: _Node, steps: tuple, top: _Node) -> bool:
    if not _fits(node, steps[-1]):
        return False
    if len(steps) == 1:
        return True
    up = node
    while up is not top and up.parent is not None:
        up = up.parent
        if _matches(up, steps[:-1], top):
            return True
        if steps[-1][0]:
            break
    return False


def _select(top: _Node, text: str) -> list[tuple[_Node, str]]:
    wanted = _selector(text)
    return [(n, attr) for n in top.all() for steps, attr in wanted if _matches(n, steps, top)]


def _values(top: _Node, text: str) -> list[str]:
    found = []
    for node, attr in _select(top, text):
        found += ([node.attrs[attr]] if attr in node.attrs else []) if attr else node.texts
    return found


def _first(top: _Node, candidates: list[str]) -> str:
    for text in candidates:
        value = next(iter(_values(top, text)), "")
        if value:
            return value.strip()
    return ""


def _absolute(url: str, link: str) -> str:
    """The link as seen from the page; one that cannot be read as a link is left as it is."""
    try:
        return urljoin(url, link)
    except ValueError:
        return link


def _fields(page: _Node, top: _Node, spec: dict, url: str) -> dict:
    image = _first(top, spec.get("image", []))
    href = _first(top, spec.get("href", []))
    return {
        "href": _absolute(url, href) if "href" in spec else url,
        "title": _first(top, spec.get("title", [])),
        "price_text": _first(top, spec["price_text"]),
        "rating_text": _first(top, spec.get("rating_text", [])),
        "stock_text": " ".join(t.strip() for t in _values(top, spec["stock_all"]) if t.strip())
        if "stock_all" in spec
        else _first(top, spec.get("stock_text", [])),
        "out_marked": any(_select(top, x) for x in spec.get("out", [])),
        "crumbs": _values(page, spec["crumbs"]) if "crumbs" in spec else [],
        "page_category": _first(page, spec.get("page_category", [])),
        "image_url": _absolute(url, image) if image and spec.get("image_absolute", True) else image,
    }


def _read_page(site: str, url: str, html: str) -> Iterator[dict]:
    layout = LAYOUTS[site]
    page = _Page(html).root
    detail, listing = layout.get("detail"), layout.get("listing")
    if detail and any(_select(page, x) for x in detail["present"]):
        row = _fields(page, page, detail, url)
        if "out_word" in detail:
            row["out_marked"] = row["out_marked"] or detail["out_word"] in html.lower()
        yield {"kind": "detail", **row}
    elif listing:
        cards = next((found for x in listing["card"] if (found := _select(page, x))), [])
        for card, _ in cards:
            yield {"kind": "listing", **_fields(page, card, listing, url)}


def _read_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [f.split()[0] for f in RAW_FIELDS.split(", ")]
    for pdf in batches:
        rows = [
            {"site": r.site, "url": r.url, "scraped_at": r.fetched_at, **found}
            for r in pdf.itertuples(index=False)
            for found in _read_page(r.site, r.url, r.html)
        ]
        yield pd.DataFrame(rows, columns=names)


def site_of(url):
    """Known shop of a URL, null for any other host."""
    host = F.regexp_replace(F.lower(F.parse_url(url, F.lit("HOST"))), r"^www\.", "")
    return F.when(host.isin(list(LAYOUTS)), host)


def read_raw_fields(pages: DataFrame) -> DataFrame:
    """Marked texts of every product on the pages ``(url, html, fetched_at[, site])``."""
    if "site" not in pages.columns:
        pages = pages.withColumn("site", site_of(F.col("url")))
    known = pages.where(F.col("site").isin(list(LAYOUTS)) & F.col("html").isNotNull())
    return known.select("site", "url", "html", "fetched_at").mapInPandas(_read_pages, RAW_FIELDS)


def _to_items(raw: DataFrame, *extra: str | Column) -> DataFrame:
    site = F.col("site")
    symbol = site.isin("books.toscrape.com", "scrapeme.live")
    rating = (
        F.when(site == "books.toscrape.com", p.rating_from_word("rating_text"))
        .when(site == "scrapeme.live", p.rating_from_label("rating_text"))
        .when(site == "jumia.ma", p.parse_star_width("rating_text"))
    )
    stock = (
        F.when(site == "books.toscrape.com", F.col("stock_text"))
        .when(site == "scrapeme.live", p.stock_from_text("stock_text"))
        .otherwise(p.stock_from_marker(F.col("out_marked")))
    )
    category = (
        F.when(site == "books.toscrape.com", p.crumb_at("crumbs", 3))
        .when(site == "scrapeme.live", F.col("page_category"))
        .when(site == "jumia.ma", p.listing_key("url"))
        .otherwise(c.first_match("page_category", p.category_from_url("url")))
    )
    return raw.select(
        *extra,
        c.product_id_from_url("href").alias("product_id"),
        site.alias("source"),
        F.col("href").alias("url"),
        "title",
        F.when(symbol, p.parse_price_symbol("price_text")).otherwise(p.parse_price_fr("price_text")).alias("price"),
        F.when(symbol, "GBP").otherwise("MAD").alias("currency"),
        rating.alias("rating"),
        stock.alias("availability"),
        category.alias("category"),
        "image_url",
        "scraped_at",
    )


def merge_detail(raw: DataFrame, how: str = "inner") -> DataFrame:
    """Items of the two-step shops: each listing completed by the detail page of the same URL and day.

    Listing and detail rows meet in one aggregation by URL and day, so pages are read once and a link
    that is listed very often is combined before the shuffle. ``how="inner"`` keeps items whose detail
    page was read, ``"left"`` all of them.
    """
    is_detail = F.col("kind") == "detail"
    items = _to_items(
        raw,
        "kind",
        "crumbs",
        F.to_date("scraped_at").alias("day"),
    )
    listed = ~is_detail & (F.col("title") != "") & (F.col("price") != 0)
    item = F.struct(*PRICE_COLUMNS)
    page = F.struct("price", "crumbs", "availability", "image_url")
    latest = F.struct("scraped_at", "price")
    merged = items.groupBy("url", "day").agg(
        F.max_by(item, F.when(listed, latest)).alias("l"), F.max_by(page, F.when(is_detail, latest)).alias("d")
    )
    merged = merged.where(F.col("l").isNotNull() & (F.col("d").isNotNull() if how == "inner" else F.lit(True)))
    better = {
        "price": F.coalesce(F.when(F.col("d.price") > 0, F.col("d.price")), F.col("l.price")),
        "category": F.coalesce(p.crumb_before_last("d.crumbs", "l.category"), F.col("l.category")),
        "availability": F.coalesce("d.availability", "l.availability"),
        "image_url": F.coalesce(F.nullif("d.image_url", F.lit("")), F.col("l.image_url")),
    }
    return merged.select(*[better.get(x, F.col(f"l.{x}")).alias(x) for x in PRICE_COLUMNS])


def extract_products(pages: DataFrame, how: str = "inner") -> DataFrame:
    """All five shops: complete items, and listings of the two-step shops merged with their details.

    Pages are read once; their marked texts, far smaller than the pages, are written and then split by shop.
    """
    raw = stash(read_raw_fields(pages), "fields")
    two_step = F.col("site").isin([site for site, layout in LAYOUTS.items() if len(layout) == 2])
    unsellable = (F.col("source") == "jumia.ma") & ((F.col("title") == "") | (F.col("price") == 0))
    direct = _to_items(raw.where(~two_step)).where(~unsellable)
    return direct.unionByName(merge_detail(raw.where(two_step), how))


ARTICLE_FIELDS = "page_id long, url string, title string, heading string, links array<string>"


def _read_articles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for page_id, url, html in pdf.itertuples(index=False):
            top = _Page(html or "").root
            links = [_absolute(url, x) if url else x for x in _values(top, "a@href")]
            rows.append((page_id, url, _first(top, ["title"]), _first(top, ["h1"]), links))
        yield pd.DataFrame(rows, columns=["page_id", "url", "title", "heading", "links"])


def extract_articles(pages: DataFrame) -> DataFrame:
    """Title, heading and absolute links of any pages ``(page_id, url, html)``, a row for each; what is not there is empty."""
    return pages.select("page_id", "url", "html").mapInPandas(_read_articles, ARTICLE_FIELDS)
