import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.sources import pages as pg

# Pages of invented products in the markup that the layouts look for.


def card(link, name, price, image="", stars=None, note=""):
    rating = f'<div class="stars"><div style="width:{stars}%"></div></div>' if stars is not None else ""
    return f"""<article class="prd"><a class="core" href="{link}"><h3 class="name">\n  {name}\t</h3><div class="prc">{price}</div>{rating}</a>
    {note}<img class="img" {image}></article>"""


def miniature(link, name, price, more="", level="h2"):
    return f"""<article class="product-miniature"><{level} class="product-title"><a href="{link}">\n   {name}\n </a></{level}>
    <span class="price">{price}</span>{more}</article>"""


def trail(*crumbs):
    return '<nav class="breadcrumb"><ol>' + "".join(f"<li><span>\n {x}\t</span></li>" for x in crumbs) + "</ol></nav>"


def page(*parts):
    return "<html><body>" + "\n".join(parts) + "</body></html>"


LISTING_ONE_STEP = page(
    card("/kettle-steel-17.html", "Steel Kettle 1.7 l", "249,90 DH", 'data-src="/img/kettle.webp"', 62),
    card("/lamp-oak.html", "Oak Desk Lamp", "1 085,00 DH", 'src="https://cdn.example.org/lamp.webp"', None, '<div class="s-info">Rupture</div>'),
    card("/gift.html", "Free Sample", ""),
    card("http://[bad", "Odd Link Mug", "35 DH"),
)
LISTING_TWO_STEP = page(
    trail("Accueil", "Claviers"),
    miniature("https://www.ultrapc.ma/claviers/tkl-red.html", "TKL Keyboard Red", "612,00 MAD", '<img class="img-fluid" src="/m/tkl.webp">'),
    miniature("/claviers/split-60.html", "Split 60", "1 940,00 MAD", '<span class="product-unavailable">Fini</span>', "h3"),
    miniature("/claviers/free.html", "No Price", ""),
    miniature("/claviers/unseen.html", "Unseen Board", "88 MAD"),
)
DETAIL_IN_STOCK = page(
    trail("Accueil", "Compacts", "TKL"),
    '<div class="product-prices"><span class="price">598,50 MAD</span></div><img class="js-qv-product-cover" src="/m/tkl-large.webp">',
)
DETAIL_OUT = page(trail("Split"), '<div class="product-prices"><span class="price">sur demande</span></div><p>Article en rupture</p>')
BOOK = page(
    '<ul class="breadcrumb"><li><a href="/">Start</a></li><li><a href="/all">All</a></li><li><a href="/g">\n  Gardening\n</a></li><li>x</li></ul>',
    '<div class="product_main"><h1>\n Soil and Seed\t</h1><p class="price_color">Â£18.35</p><p class="star-rating Four"></p>',
    '<p class="availability">\n\t 7 copies left\n</p></div><div id="product_gallery"><img src="../pics/soil.webp"></div>',
)
CREATURE = page(
    '<h1 class="product_title">Mossling</h1><p class="price"><span class="woocommerce-Price-amount"><bdi><span>£</span>27.40</bdi></span></p>',
    '<p class="stock">12 in stock</p><span class="posted_in"><a href="/k">Forest kin</a></span>',
    '<div class="woocommerce-product-rating"><span class="star-rating" aria-label="2.75 out of 5"></span></div>',
    '<div class="woocommerce-product-gallery__image"><a href="https://scrapeme.live/big/moss.webp"><img src="/s/moss.webp"></a></div>',
)

NOW = dt.datetime(2026, 4, 24, 12, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def items(spark):
    shop = [
        ("https://www.jumia.ma/petite-cuisine/", LISTING_ONE_STEP),
        ("https://www.ultrapc.ma/31-claviers?page=4", LISTING_TWO_STEP),
        ("https://www.ultrapc.ma/claviers/tkl-red.html", DETAIL_IN_STOCK),
        ("https://www.ultrapc.ma/claviers/split-60.html", DETAIL_OUT),
        ("https://books.toscrape.com/list/soil/index.html", BOOK),
        ("https://scrapeme.live/shop/mossling/", CREATURE),
        ("https://elsewhere.example/x", LISTING_ONE_STEP),
        ("https://www.jumia.ma/broken/", "<article class='prd'><h3 class=name>x<div"),
        ("https://books.toscrape.com/empty", ""),
    ]
    return spark.createDataFrame([(u, h, NOW) for u, h in shop], "url string, html string, fetched_at timestamp")


def by_title(df):
    return {r.title: r for r in df.collect()}


def test_all_shops(items):
    got = by_title(pg.extract_products(items))
    assert set(got) == {"Steel Kettle 1.7 l", "Oak Desk Lamp", "Odd Link Mug", "TKL Keyboard Red", "Split 60", "Soil and Seed", "Mossling"}
    kettle, lamp = got["Steel Kettle 1.7 l"], got["Oak Desk Lamp"]
    assert (kettle.price, kettle.currency, kettle.rating, kettle.source, kettle.availability) == (249.9, "MAD", 3.1, "jumia.ma", "In Stock")
    assert kettle.category == "Petite Cuisine" and kettle.image_url == "/img/kettle.webp"  # this shop's images stay as written
    assert kettle.product_id == hashlib.md5(b"https://www.jumia.ma/kettle-steel-17.html").hexdigest()
    assert (lamp.availability, lamp.rating, lamp.image_url) == ("Out of Stock", None, "https://cdn.example.org/lamp.webp")
    book = got["Soil and Seed"]
    assert (book.price, book.rating, book.availability, book.category) == (18.35, 4.0, "7 copies left", "Gardening")
    assert book.image_url == "https://books.toscrape.com/list/pics/soil.webp"
    creature = got["Mossling"]
    assert (creature.price, creature.rating, creature.availability, creature.category) == (27.4, 2.75, "In Stock", "Forest kin")
    assert creature.image_url == "https://scrapeme.live/big/moss.webp"


def test_a_link_that_is_none_ends_no_job(items):
    assert by_title(pg.extract_products(items))["Odd Link Mug"].url == "http://[bad"


def test_detail_completes_listing(items):
    got = by_title(pg.extract_products(items))
    tkl, split = got["TKL Keyboard Red"], got["Split 60"]
    assert (tkl.price, tkl.category, tkl.availability) == (598.5, "Compacts", "In Stock")
    assert tkl.image_url == "https://www.ultrapc.ma/m/tkl-large.webp"
    assert (split.price, split.category, split.availability) == (1940.0, "Claviers", "Out of Stock")
    every = by_title(pg.extract_products(items, how="left"))
    assert every["Unseen Board"].category == "Claviers" and set(every) - set(got) == {"Unseen Board"}


def test_listing_repeated_many_times(spark, items):
    copies = items.crossJoin(spark.range(30)).drop("id")
    got = pg.extract_products(copies).where(F.col("source") == "ultrapc.ma")
    assert got.count() == 2


def test_selectors():
    page = pg._Page("<div class='a b'><ul><li>1<li><b>2</b> x</li></ul><br><p id=i data-x='y'>t&amp;u</p></div>").root
    assert pg._values(page, "li") == ["1", " x"]
    assert pg._values(page, "ul li:last-child b") == ["2"]
    assert pg._values(page, "div.a.b > p#i") == ["t&u"]
    assert pg._values(page, "div > b") == []
    assert pg._values(page, "p@data-x") == ["y"] and pg._values(page, "p@none") == []
    assert pg._first(page, ["h1", "b", "li"]) == "2"
