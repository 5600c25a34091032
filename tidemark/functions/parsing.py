"""Parsers for scraped text, written as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.cleaning import SPACES, _col, lookup, strip
from tidemark.schema import STARS_BY_WORD


# A number that is a word.
INFINITE = ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity"]
#: White space of any script, with the flag U.
BLANK = r"\s\x1c-\x1f"


def _number(source: Column, text: Column, noise: str) -> Column:
    """``text``, what is left of ``source`` without noise, as a number, else 0.

    Only what is written as a number is cast, which the source shows already: a cast that fails costs an exception, many
    times the price of the pattern. A letter like the suffix in '2f' is no part of a number.
    """
    other = source.rlike(f"(?U)[^{noise}0-9.,+eE-]")
    word = F.trim(source)
    number = F.when(~other, text.try_cast("double")).when(F.lower(word).isin(INFINITE), word.try_cast("double"))
    return F.coalesce(number, F.lit(0.0))


LOCAL_NOISE = f"DdHhMmAa{BLANK}"


def parse_price_fr(c: Column | str) -> Column:
    """'4 299,00 DH' -> 4299.0. The rightmost of , and . is the decimal mark; a lone comma
    before exactly three digits groups thousands; text that is no number gives 0.

    Marks are looked for in the text as it is; what is left without noise is computed anew in the few places that name
    it, inside the generated code, which costs less than a lambda that computes it once.
    """
    text = F.regexp_replace(_col(c), f"(?U)[{LOCAL_NOISE}]+", "")
    comma, dot = F.contains(_col(c), F.lit(",")), F.contains(_col(c), F.lit("."))
    dot_last = F.contains(F.substring_index(_col(c), ",", -1), F.lit("."))
    plain = (
        F.when(~comma, text)
        .when(dot & ~dot_last, _replace(_replace(text, ".", ""), ",", "."))
        .when(dot | text.rlike(r"^\d+,[^,]{3}$"), _replace(text, ",", ""))
        .otherwise(_replace(text, ",", "."))
    )
    return _number(_col(c), plain, LOCAL_NOISE)


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def parse_price_symbol(c: Column | str) -> Column:
    """'£51.77' -> 51.77; non-ASCII marks, $ , and spaces are dropped, other text gives 0."""
    text = F.regexp_replace(_col(c), r"[$, \x{80}-\x{10FFFF}]+", "")
    return _number(_col(c), text, r"$ \x{80}-\x{10FFFF}")


def _plain_number(text: Column) -> Column:
    """Cast that does not accept the type suffixes ('1d', '2f') the JVM would."""
    return F.when(~F.lower(F.right(text, F.lit(1))).isin("d", "f"), text.try_cast("double"))


def parse_star_width(c: Column | str) -> Column:
    """'width:76%' -> 3.8 (a full star is 20 %)."""
    pct = F.regexp_extract(_col(c), r"(\d+(?:\.\d+)?)\s*%", 1)
    return F.round(pct.try_cast("double") / 20, 1)


def rating_from_word(c: Column | str) -> Column:
    """Last word of a CSS class, One..Five."""
    return lookup(F.try_element_at(F.split(strip(c), f"[{SPACES}]+"), F.lit(-1)), STARS_BY_WORD)


def rating_from_label(c: Column | str) -> Column:
    """'3.00 out of 5' -> 3.0."""
    return _plain_number(F.split_part(strip(c), F.lit(" "), F.lit(1)))


def stock_from_text(c: Column | str) -> Column:
    return F.when(F.contains(F.lower(_col(c)), F.lit("in stock")), "In Stock").otherwise("Out of Stock")


def stock_from_marker(out: Column) -> Column:
    return F.when(out, "Out of Stock").otherwise("In Stock")


def title_case(c: Column | str) -> Column:
    """Every run of letters starts with a capital, also after digits and apostrophes."""
    runs = F.regexp_extract_all(F.lower(_col(c)), F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def category_from_url(url: Column | str) -> Column:
    """Last path segment without the query, in title case."""
    path = F.rtrim(F.split_part(_col(url), F.lit("?"), F.lit(1)), F.lit("/"))
    return title_case(F.replace(F.element_at(F.split(path, "/"), -1), F.lit("-"), F.lit(" ")))


def listing_key(url: Column | str) -> Column:
    """Last segment first, query dropped afterwards."""
    segment = F.element_at(F.split(F.rtrim(_col(url), F.lit("/")), "/"), -1)
    return title_case(F.replace(F.split_part(segment, F.lit("?"), F.lit(1)), F.lit("-"), F.lit(" ")))


def crumb_at(crumbs: Column | str, position: int) -> Column:
    """1-based breadcrumb from the left, '' if the trail is shorter."""
    return F.coalesce(strip(F.try_element_at(_col(crumbs), F.lit(position))), F.lit(""))


def crumb_before_last(crumbs: Column | str, otherwise: Column | str) -> Column:
    return F.when(F.size(_col(crumbs)) >= 2, strip(F.try_element_at(_col(crumbs), F.lit(-2)))).otherwise(
        _col(otherwise)
    )


def join_texts(parts: Column | str) -> Column:
    """Join text nodes by a blank, leaving out empty ones."""
    stripped = F.transform(_col(parts), strip)
    return F.array_join(F.filter(stripped, lambda x: x != ""), " ")
