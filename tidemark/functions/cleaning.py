"""Column expressions that clean and derive fields. All of them stay inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import SOURCE_BY_HOST

MAX_MILLIS = 9223372036854775807

# The characters that count as white space.
#: White space of any script, as a regular expression's class body.
SPACES = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$|^[+-]?(?i:inf(?:inity)?)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(c: Column | str, mapping: dict, default: Column | None = None) -> Column:
    """Value of a small dictionary, else ``default`` (null when not given)."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), _col(c))
    return found if default is None else F.coalesce(found, default)


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def strip(c: Column | str) -> Column:
    """Text without white space of any kind around it."""
    return F.regexp_replace(_col(c), f"^[{SPACES}]+|[{SPACES}]+$", "")


def to_number(c: Column | str) -> Column:
    """Numeric value, null where the text is no plain number: a type suffix or a hexadecimal form is none."""
    raw = _col(c).cast("string")
    # Most texts have nothing to strip, which costs more than to see that.
    return F.coalesce(*[F.when(text.rlike(NUMBER), text.try_cast("double")) for text in (raw, strip(raw))])


def to_utc(c: Column | str) -> Column:
    """ISO-8601 text to an instant, null where it cannot be read."""
    return F.try_to_timestamp(_col(c).cast("string"))


def normalize_source(c: Column | str) -> Column:
    trimmed = strip(c)
    return lookup(F.lower(trimmed), SOURCE_BY_HOST, trimmed)


def normalize_availability(c: Column | str) -> Column:
    text = F.lower(strip(F.regexp_replace(F.coalesce(_col(c), F.lit("")), f"[{SPACES}]+", " ")))
    digits = F.nullif(F.regexp_extract(text, r"(\d+)", 1), F.lit(""))
    count = digits.try_cast("decimal(38,0)")
    return (
        F.when(F.contains(text, F.lit("out")), "Out of stock")
        .when(F.contains(text, F.lit("pre")), "Pre-order")
        .when(count <= 5, F.concat(count.cast("string"), F.lit(" available")))
        .otherwise("In stock")
    )


def surrogate_product_id(title: Column | str, source: Column | str) -> Column:
    joined = F.concat_ws("_", F.coalesce(_col(title), F.lit("")), F.coalesce(_col(source), F.lit("")))
    return F.regexp_replace(F.lower(joined), r"(?U)\W+", "_")


def product_id_from_url(url: Column | str) -> Column:
    return F.md5(_col(url))


def price_change_abs(price: Column | str, prev: Column | str) -> Column:
    return _col(price) - _col(prev)


def price_change_pct(price: Column | str, prev: Column | str, digits: int | None = 2) -> Column:
    """Relative change in percent; null without a previous price or with a zero one."""
    pct = F.try_divide(_col(price) - _col(prev), _col(prev)) * 100
    return pct if digits is None else F.round(pct, digits)


def row_key(product_id: Column | str, at: Column | str) -> Column:
    """``id#`` + reversed epoch milliseconds, so that the newest key of an id sorts first."""
    reverse = F.lit(MAX_MILLIS).cast("long") - F.unix_millis(_col(at))
    return F.concat_ws("#", _col(product_id), F.lpad(reverse.cast("string"), 19, "0"))


def encode_cell(c: Column | str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def default_event_time(at: Column | str, now: Column | None = None) -> Column:
    return F.coalesce(_col(at), F.current_timestamp() if now is None else now)


def severity(pct: Column | str) -> Column:
    """Class of a price drop."""
    return F.when(_col(pct) <= -20, "severe").when(_col(pct) <= -10, "moderate").otherwise("mild")


def truncate(c: Column | str, n: int) -> Column:
    return F.substring(_col(c), 1, n)


def significant(p: Column | str, alpha: float = 0.05) -> Column:
    return F.when(_col(p) < alpha, "Yes").otherwise("No")


def normal_verdict(p: Column | str, alpha: float = 0.05) -> Column:
    return F.when(_col(p) >= alpha, "Yes").otherwise("No")


def trend_label(slope: Column | str) -> Column:
    return F.when(_col(slope) > 0, "Rising").otherwise("Falling")


def effect_label(d: Column | str) -> Column:
    size = F.abs(_col(d))
    return F.when(size >= 0.8, "large").when(size >= 0.5, "medium").otherwise("small")


def first_match(*candidates: Column | str) -> Column:
    """First candidate that is neither null nor empty, else ''."""
    return F.coalesce(*[blank_to_null(c) for c in candidates], F.lit(""))


def days_between(start: Column, at: Column | str) -> Column:
    return (F.unix_micros(_col(at)) - F.unix_micros(start)) / F.lit(86_400_000_000.0)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
