import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import cleaning as c
from tidemark.functions import parsing as p
from tidemark.schema import PRICE_SCHEMA


def evaluate(spark, values, expr, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("v"))).collect()]


def check(spark, cases, expr, kind="string"):
    got = evaluate(spark, [x for x, _ in cases], expr, kind)
    for (raw, want), have in zip(cases, got):
        if isinstance(want, float):
            assert have == pytest.approx(want), raw
        else:
            assert have == want, raw


def test_price_fr(spark):
    """Every way to write a price of our own numbers, and texts that hold none."""
    cases = []
    for whole, cents in ((7, 5), (68, 40), (935, 99), (2716, 25), (48120, 75)):
        value = whole + cents / 100
        blank, dotted = f"{whole:,}".replace(",", " "), f"{whole:,}".replace(",", ".")
        for unit in ("DH", "MAD"):
            cases += [(f"{blank},{cents:02} {unit}", value), (f"{dotted},{cents:02} {unit}", value), (f"{whole} {unit}", float(whole)), (f"{blank} {unit}", float(whole))]
    cases += [("", 0.0), (None, 0.0), ("sur demande", 0.0), ("6,120 DH", 6120.0), ("6,120.50", 6120.5), ("6.120 DH", 6.12), ("6.120,00 Dhs", 0.0)]
    cases += [("7,8,9", 0.0), ("3f", 0.0), ("34,5 DH", 34.5), ("-8 DH", -8.0), (",250", 0.25), ("8,765,432.5", 8765432.5), ("8.765.432,5", 8765432.5), ("\t77\u00a0DH\n", 77.0)]
    check(spark, cases, p.parse_price_fr)


def test_price_symbol(spark):
    cases = [("£51.77", 51.77), ("Â£51.77", 51.77), ("$1,234.50", 1234.5), ("€ 9", 9.0), ("", 0.0), ("free", 0.0), (None, 0.0), ("5d", 0.0)]
    check(spark, cases, p.parse_price_symbol)


def test_ratings(spark):
    """Widths in percent of five stars, number words as a class, and labels."""
    widths = [(f"{lead}{w}%", round(w / 20, 1)) for w in (4, 14, 38, 52, 66, 92, 98) for lead in ("width:", "left:0;width: ")]
    check(spark, widths + [("height 9", None), ("", None), (None, None)], p.parse_star_width)
    words = [(f"\tstar-rating {w}\n", float(i + 1)) for i, w in enumerate(("One", "Two", "Three", "Four", "Five"))]
    check(spark, words + [("star-rating Seven", None), ("", None), (None, None)], p.rating_from_word)
    check(spark, [("\n2.25 out of 5", 2.25), ("1 out of 5", 1.0), ("", None), ("unrated", None)], p.rating_from_label)


def test_text_helpers(spark):
    check(spark, [("99 In Stock", "In Stock"), ("Out of stock", "Out of Stock")], p.stock_from_text)
    check(
        spark,
        [("https://x.ma/19-laptops?page=2", "19 Laptops"), ("https://x.ma/a/pc-de-bureau/", "Pc De Bureau"), ("https://x.ma/pc2go-l'x", "Pc2Go L'X")],
        p.category_from_url,
    )
    check(
        spark,
        [("https://x.ma/ordinateurs-portables/", "Ordinateurs Portables"), ("https://x.ma/tv/?page=2", ""), ("https://x.ma/tv?page=2", "Tv")],
        p.listing_key,
    )
    check(spark, [([" a ", "\n", "b"], "a b"), ([], "")], p.join_texts, "array<string>")
    check(spark, [(["Home", "Books", " Poetry "], "Poetry"), (["Home"], "")], lambda x: p.crumb_at(x, 3), "array<string>")
    check(spark, [(["H", " Laptops", "x"], "Laptops"), (["x"], "old"), (None, None)], lambda x: F.when(x.isNotNull(), p.crumb_before_last(x, F.lit("old"))), "array<string>")


def test_normalize(spark):
    check(spark, [(" Jumia.MA ", "jumia_ma"), (" Other ", "Other"), ("books.toscrape.com", "books_toscrape"), ("\tscrapeme.live\n", "scrapeme_live"), (None, None)], c.normalize_source)
    check(
        spark,
        [
            ("Out of stock", "Out of stock"), ("Pre-order", "Pre-order"), ("3 available", "3 available"), ("99 in stock", "In stock"),
            ("  In\n stock ", "In stock"), (None, "In stock"), ("", "In stock"), ("0 left", "0 available"), ("9999999999999999999 left", "In stock"),
        ],
        c.normalize_availability,
    )


def test_numbers_and_times(spark):
    cases = [("12.5", 12.5), (" 7\n", 7.0), ("-.5e2", -50.0), ("x", None), ("", None), (None, None), ("1d", None), ("2f", None), ("0x1p3", None), ("NaN", None)]
    check(spark, cases, c.to_number)
    utc = dt.datetime(2026, 4, 24, 12)
    for text in ("2026-04-24T12:00:00+00:00", "2026-04-24T12:00:00Z", "2026-04-24T14:00:00+02:00"):
        got = evaluate(spark, [text], lambda v: c.to_utc(v).cast("timestamp_ntz"))
        assert got == [utc]
    assert evaluate(spark, ["bad", None], c.to_utc) == [None, None]


def test_change_and_labels(spark):
    df = spark.createDataFrame([(99.0, 110.0), (5.0, 0.0), (9500.4, 10000.0), (1.0, None)], "p double, q double")
    assert [r[0] for r in df.select(c.price_change_pct("p", "q")).collect()] == [-10.0, None, -5.0, None]
    check(spark, [(-25.0, "severe"), (-20.0, "severe"), (-10.0, "moderate"), (-5.0, "mild")], c.severity, "double")
    check(spark, [(-0.9, "large"), (0.5, "medium"), (0.1, "small")], c.effect_label, "double")
    check(spark, [(0.04, "Yes"), (0.05, "No")], c.significant, "double")
    check(spark, [(0.1, "Rising"), (0.0, "Falling")], c.trend_label, "double")
    check(spark, [("", "b"), ("a", "a"), (None, "b")], lambda v: c.first_match(v, F.lit("b")))


def test_row_key(spark):
    at = dt.datetime(2026, 4, 24, 12, 0, tzinfo=dt.timezone.utc)
    later = at + dt.timedelta(seconds=1)
    df = spark.createDataFrame([("abc", at), ("abc", later)], "id string, at timestamp")
    first, second = [r[0] for r in df.orderBy("at").select(c.row_key("id", "at")).collect()]
    assert first == "abc#9223370259822775807"
    assert first.count("#") == 1 and len(first.split("#")[1]) == 19
    assert second < first


def test_surrogate_id(spark):
    df = spark.createDataFrame([("L'été 2024!", "jumia_ma"), (None, "x")], "t string, s string")
    assert [r[0] for r in df.select(c.surrogate_product_id("t", "s")).collect()] == ["l_été_2024__jumia_ma", "_x"]


def test_schema():
    assert PRICE_SCHEMA.fieldNames() == [
        "product_id", "source", "url", "title", "price", "currency", "rating", "availability", "category", "image_url", "scraped_at",
    ]
