"""Every registered query, with the same result written in SQL beside it where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import cleaning as c
from tidemark.functions import parsing as p
from tidemark.operators import daily
from tidemark.operators import descriptive as d
from tidemark.operators import history as h
from tidemark.operators import inference as i
from tidemark.operators import quality as q
from tidemark.operators import sampling
from tidemark.operators import serving as sv
from tidemark.operators import staging as st
from tidemark.operators.distribution import quantiles
from tidemark.operators.small import salted_join
from tidemark.plans import marts as m
from tidemark.plans import reports
from tidemark.schema import KNOWN_HOSTS, PRICE_COLUMNS, PRICE_SCHEMA
from tidemark.session import fresh_dir, stash
from tidemark.sources import daily_table, families, files, kafka, pages, tables, widerow
from tidemark.streaming import ingest, live

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def plain(df: DataFrame) -> DataFrame:
    """Instants as UTC wall times, the type the given tables use."""
    return df.select(
        *[F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f"`{f.name}`")
          for f in df.schema.fields]
    )


# --------------------------------------------------------------------------- SQL building blocks

RAW = """raw AS (
  SELECT 'p' || user_id AS product_id,
    CASE event_type WHEN 'click' THEN 'books.toscrape.com' WHEN 'error' THEN 'scrapeme.live'
      WHEN 'purchase' THEN 'jumia.ma' WHEN 'signup' THEN 'ultrapc.ma' WHEN 'view' THEN 'micromagma.ma' END AS source,
    'https://shop.example.com/p/' || user_id AS url,
    '  Product ' || user_id || ' ' || chr(10) AS title,
    value AS price,
    CASE WHEN event_type IN ('click', 'error') THEN ' gbp' ELSE 'mad' || chr(9) END AS currency,
    CAST(k % 51 AS DOUBLE) / 10 AS rating,
    CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN ' In stock' WHEN 2 THEN k || ' available' END AS availability,
    CASE WHEN k % 13 = 0 THEN ' ' || chr(10) || chr(9) ELSE 'Cat ' || (k % 6) END AS category,
    CASE WHEN k % 3 = 0 THEN '' ELSE 'https://img.example.com/' || user_id END AS image_url,
    ts AS scraped_at, event_id
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events))"""

STG = RAW + """, stg AS (
  SELECT product_id, source, url, trim(title, ' ' || chr(9) || chr(10)) AS title, price, upper(trim(currency, ' ' || chr(9) || chr(10))) AS currency, rating,
    coalesce(nullif(trim(availability, ' ' || chr(9) || chr(10)), ''), 'Unknown') AS availability,
    nullif(trim(category, ' ' || chr(9) || chr(10)), '') AS category, nullif(image_url, '') AS image_url,
    scraped_at, CAST(scraped_at AS DATE) AS scraped_date, event_id
  FROM raw WHERE product_id IS NOT NULL AND source IS NOT NULL AND price >= 0),
pos AS (SELECT * FROM stg WHERE price > 0)"""

DED = STG + """, ded AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
    PARTITION BY product_id, scraped_date ORDER BY scraped_at DESC, event_id DESC) AS rn FROM stg) WHERE rn = 1)"""


def rnd(x: str, n: int) -> str:
    """Round half up on the shortest decimal text of a double, as the JVM does."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), {n}) AS DOUBLE)"


def pctl(x: str, share: float, cond: str = "") -> str:
    """Linear interpolation between the two neighbours of a rank."""
    vals = f"list({x} ORDER BY {x}){cond}"
    pos = f"({share} * (len({vals}) - 1))"
    lo, hi = f"floor({pos})", f"ceil({pos})"
    return (
        f"CASE WHEN {lo} = {hi} THEN ({vals})[CAST({pos} AS BIGINT) + 1] ELSE ({hi} - {pos}) * "
        f"({vals})[CAST({lo} AS BIGINT) + 1] + ({pos} - {lo}) * ({vals})[CAST({hi} AS BIGINT) + 1] END"
    )


def disc(x: str, share: float) -> str:
    """The value at the rank that is rounded up."""
    return rnd(f"(list({x} ORDER BY {x}))[CAST(ceil({share} * count(*)) AS BIGINT)]", 2)


PCT = "CASE WHEN prev_price IS NULL OR prev_price = 0 THEN NULL ELSE " + rnd("(price - prev_price) / prev_price * 100", 2) + " END"

CHG = DED + f""", chg AS (
  SELECT *, {PCT} AS price_change_pct, price - prev_price AS price_change_abs FROM (
    SELECT *, lag(price) OVER w AS prev_price, lag(scraped_date) OVER w AS prev_date
    FROM ded WINDOW w AS (PARTITION BY product_id ORDER BY scraped_at)))"""

ALERT_SELECT = """SELECT product_id, source, title, url, currency, price AS current_price, prev_price, price_change_pct,
  price_change_abs, prev_date, scraped_date AS alert_date, scraped_at FROM chg
  WHERE price_change_pct <= -5 AND scraped_date >= (SELECT max(scraped_date) FROM stg) - INTERVAL 7 DAY"""

ALERTS = CHG + ", alerts AS (" + ALERT_SELECT + ")"

CUR_ONLY = """cur AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY scraped_at DESC) AS rn
    FROM ded) WHERE rn = 1)"""
CUR = DED + ", " + CUR_ONLY

CUR_COLS = "product_id, source, title, url, price, currency, rating, availability, category, scraped_at, scraped_date"
HIST_COLS = ("product_id, source, title, url, currency, price, prev_price, price_change_pct, price_change_abs, "
             "prev_date, scraped_date, scraped_at")

SKEW = "(avg(({x} - mu) ** 3) / nullif(avg(({x} - mu) ** 2) ** 1.5, 0))"

STATS_SELECT = f"""SELECT source, currency, count(DISTINCT product_id) AS product_count, count(*) AS observation_count,
  {rnd('avg(price)', 2)} AS avg_price, {rnd('min(price)', 2)} AS min_price, {rnd('max(price)', 2)} AS max_price,
  {rnd('stddev_samp(price)', 2)} AS stddev_price, {rnd(pctl('price', 0.25), 2)} AS p25_price,
  {rnd(pctl('price', 0.5), 2)} AS median_price, {rnd(pctl('price', 0.75), 2)} AS p75_price,
  min(scraped_date) AS first_seen_date, max(scraped_date) AS last_updated_date FROM ded GROUP BY 1, 2"""

LINES = """lines AS (
  SELECT CAST(l_partkey AS VARCHAR) AS product_id, p_brand AS source,
    'https://shop.example.com/part/' || l_partkey AS url, p_name AS title, l_extendedprice AS price, 'USD' AS currency,
    l_quantity / 10 AS rating, 'In stock' AS availability, p_type AS category, l_shipdate AS scraped_at,
    CAST(l_shipdate AS DATE) AS scraped_date, l_orderkey, l_linenumber, l_suppkey
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

LINE_DED = LINES + """, ded AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY product_id, scraped_date
    ORDER BY scraped_at DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) AS rn FROM lines) WHERE rn = 1)"""


def simpson(f: str, lo: str, hi: str, n: int = 2000) -> str:
    """Integral of ``f`` (written in x) from ``lo`` to ``hi`` by Simpson's rule."""
    x = f"(({lo}) + j * (({hi}) - ({lo})) / {n})"
    weight = f"(CASE WHEN j = 0 OR j = {n} THEN 1 WHEN j % 2 = 1 THEN 4 ELSE 2 END)"
    body = f.replace("{x}", x)
    return f"((({hi}) - ({lo})) / {3 * n} * list_sum(list_transform(range(0, {n + 1}), lambda j: {weight} * {body})))"


def sql_t_p(t: str, df: str) -> str:
    front = f"exp(lgamma((({df}) + 1) / 2) - lgamma(({df}) / 2)) / sqrt(({df}) * pi())"
    area = simpson(f"power(1 + {{x}} * {{x}} / ({df}), -(({df}) + 1) / 2)", "0.0", f"least(abs({t}), 60)")
    return f"greatest(0, 1 - 2 * {front} * {area})"


def sql_f_p(f: str, d1: str, d2: str) -> str:
    """Upper tail of F from the lower part of the beta integral; the integrand is negligible beyond 400 / d2."""
    y = f"least(({d1}) * ({f}) / (({d2}) + ({d1}) * ({f})), 400.0 / ({d2}), 1.0)"
    front = f"exp(lgamma((({d1}) + ({d2})) / 2) - lgamma(({d1}) / 2) - lgamma(({d2}) / 2))"
    area = simpson(f"power({{x}}, ({d1}) / 2 - 1) * power(1 - {{x}}, ({d2}) / 2 - 1)", "0.0", y)
    return f"greatest(0, 1 - {front} * {area})"


def sql_norm_p(z: str) -> str:
    area = simpson("exp(-{x} * {x} / 2)", "0.0", f"least(abs({z}), 12)")
    return f"greatest(0, 1 - 2 / sqrt(2 * pi()) * {area})"


def sql_chi2_p4(x: str) -> str:
    """Upper tail of chi square with four degrees of freedom."""
    return f"(exp(-({x}) / 2) * (1 + ({x}) / 2))"


# --------------------------------------------------------------------------- relations used below


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return tables.raw_events(spark, sf)


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return st.stage_prices(raw(spark, sf))


def positive(spark: SparkSession, sf: str) -> DataFrame:
    return st.positive_price(staged(spark, sf))


def deduped(spark: SparkSession, sf: str) -> DataFrame:
    return h.dedupe_daily(staged(spark, sf), tables.EVENT_TIE)


def changes(spark: SparkSession, sf: str) -> DataFrame:
    return h.price_changes(deduped(spark, sf))


def narrow(rows: DataFrame) -> DataFrame:
    """What changes over time are made from."""
    return rows.select("product_id", "source", "category", "price", "scraped_at", "event_id")


def last_day(spark: SparkSession, sf: str) -> Column:
    """Latest day in the data, the fixed 'today' of the alert window."""
    ts = tables.read_table(spark, sf, "events").agg(F.max("ts").cast("date").alias("d"))
    return ts.scalar()


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    return m.price_alerts(changes(spark, sf), last_day(spark, sf))


def current(spark: SparkSession, sf: str) -> DataFrame:
    return m.current_prices(deduped(spark, sf))


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return st.stage_prices(tables.raw_lines(spark, sf))


def lines_deduped(spark: SparkSession, sf: str) -> DataFrame:
    return h.dedupe_daily(lines(spark, sf), tables.LINE_TIE)


# --------------------------------------------------------------------------- staging and marts

register("stage_prices", f"WITH {STG} SELECT * FROM stg")(staged)
register("dedupe_daily", f"WITH {DED} SELECT * FROM ded")(deduped)
register("price_changes", f"WITH {CHG} SELECT product_id, scraped_at, price, prev_price, prev_date, price_change_pct, price_change_abs FROM chg")(
    lambda s, f: changes(s, f).select(
        "product_id", "scraped_at", "price", "prev_price", "prev_date", "price_change_pct", "price_change_abs"
    )
)
register("price_alerts", f"WITH {CHG} {ALERT_SELECT}")(alerts)
register("price_history", f"WITH {CHG} SELECT {HIST_COLS} FROM chg")(lambda s, f: m.price_history(changes(s, f)))
register("current_prices", f"WITH {CUR} SELECT {CUR_COLS} FROM cur")(current)
register("current_prices_by_join", f"WITH {CUR} SELECT {CUR_COLS} FROM cur")(
    lambda s, f: m.current_prices_by_join(deduped(s, f))
)
register("price_stats", f"WITH {DED} {STATS_SELECT}")(lambda s, f: m.price_stats(deduped(s, f)))
# Approximate quartiles are values of the group; up to 10,000 rows in a group they are the exact ones of that kind.
register(
    "price_stats_approx",
    f"""WITH {DED} """ + STATS_SELECT.replace(rnd(pctl('price', 0.25), 2), disc('price', 0.25)).replace(rnd(pctl('price', 0.5), 2), disc('price', 0.5)).replace(rnd(pctl('price', 0.75), 2), disc('price', 0.75)),
)(lambda s, f: m.price_stats(deduped(s, f), approx=True))
register("lineitem_price_stats", f"WITH {LINE_DED} {STATS_SELECT}")(lambda s, f: m.price_stats(lines_deduped(s, f)))
register(
    "lineitem_price_alerts",
    f"""WITH {LINE_DED}, chg AS (
  SELECT *, {PCT} AS price_change_pct, price - prev_price AS price_change_abs FROM (
    SELECT *, lag(price) OVER w AS prev_price, lag(scraped_date) OVER w AS prev_date
    FROM ded WINDOW w AS (PARTITION BY product_id ORDER BY scraped_at))), stg AS (SELECT * FROM ded)
  {ALERT_SELECT.replace('INTERVAL 7 DAY', 'INTERVAL 365 DAY')}""",
)(
    lambda s, f: m.price_alerts(
        h.price_changes(lines_deduped(s, f)),
        tables.read_table(s, f, "lineitem").agg(F.max("l_shipdate").cast("date").alias("d")).scalar(),
        days=365,
    )
)


@register(
    "materialized_marts",
    f"""WITH {ALERTS}, {CUR_ONLY}
  SELECT 'current_prices' AS mart, count(*) AS row_count, {rnd('sum(price)', 2)} AS total FROM cur
  UNION ALL SELECT 'price_alerts', count(*), {rnd('sum(current_price)', 2)} FROM alerts
  UNION ALL SELECT 'price_history', count(*), {rnd('sum(price)', 2)} FROM chg
  UNION ALL SELECT 'price_stats', count(*), {rnd('sum(avg_price)', 2)} FROM ({STATS_SELECT})""",
)
def materialized_marts(spark: SparkSession, sf: str) -> DataFrame:
    """The whole flow: build every mart, write it as a table, read it back."""
    written = m.publish_marts(raw(spark, sf), fresh_dir(spark, "marts"), last_day(spark, sf), tables.EVENT_TIE)
    value = {"current_prices": "price", "price_alerts": "current_price", "price_history": "price", "price_stats": "avg_price"}
    parts = [
        table.agg(F.count(F.lit(1)).alias("row_count"), F.round(F.sum(value[name]), 2).alias("total")).select(
            F.lit(name).alias("mart"), "row_count", "total"
        )
        for name, table in written.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# --------------------------------------------------------------------------- daily states and rolling features


def daily_sql(rows: str) -> str:
    return f"""SELECT product_id, scraped_date, count(*) AS observations, {rnd('sum(CAST(price AS DECIMAL(28, 8)))::DOUBLE / count(*)', 2)} AS avg_price, min(price) AS min_price, max(price) AS max_price,
  {rnd('stddev_samp(price)', 2)} AS stddev_price, (min({{'at': scraped_at, 'price': price}})).price AS open_price,
  (max({{'at': scraped_at, 'price': price}})).price AS close_price FROM {rows} GROUP BY 1, 2"""


def rolling_sql(rows: str) -> str:
    """From single prices, without any daily state."""
    return f"""SELECT DISTINCT product_id, scraped_date, {rnd('CAST(sum(CAST(price AS DECIMAL(28, 8))) OVER short AS DOUBLE) / count(*) OVER short', 2)} AS avg_7d, {rnd('CAST(sum(CAST(price AS DECIMAL(28, 8))) OVER wide AS DOUBLE) / count(*) OVER wide', 2)} AS avg_30d, min(price) OVER wide AS min_30d,
  max(price) OVER wide AS max_30d, {rnd('stddev_samp(price) OVER wide', 2)} AS volatility, count(DISTINCT scraped_date) OVER wide AS days_30d FROM {rows}
  WINDOW short AS (PARTITION BY product_id ORDER BY scraped_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW),
    wide AS (PARTITION BY product_id ORDER BY scraped_date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)"""


register("daily_price_stats", f"WITH {STG} {daily_sql('stg')}")(lambda s, f: daily.daily_price_stats(daily.daily_states(staged(s, f))))
register("rolling_features", f"WITH {STG} {rolling_sql('stg')}")(lambda s, f: daily.rolling_features(daily.daily_states(staged(s, f))))
register("lineitem_rolling_features", f"WITH {LINES} {rolling_sql('lines')}")(lambda s, f: daily.rolling_features(daily.daily_states(lines(s, f))))


def in_loads(spark: SparkSession, sf: str, parts: int = 3) -> str:
    """The table of daily states after the events came in several loads that overlap in days, one of them twice."""
    base, rows = fresh_dir(spark, "daily"), staged(spark, sf)
    for k in [*range(parts), 0]:
        daily_table.load_days(rows.where(F.col("event_id") % parts == k), base, f"part-{k}")
    return base


register("daily_table_by_loads", f"WITH {STG} {daily_sql('stg')}")(lambda s, f: daily.daily_price_stats(daily_table.read_days(s, in_loads(s, f))))


@register(
    "latest_features",
    f"""WITH {STG}, today AS (SELECT max(scraped_date) AS d FROM stg)
  SELECT product_id, {rnd('CAST(sum(CAST(price AS DECIMAL(28, 8))) FILTER (scraped_date > d - 7) AS DOUBLE) / count(*) FILTER (scraped_date > d - 7)', 2)} AS avg_7d, {rnd('sum(CAST(price AS DECIMAL(28, 8)))::DOUBLE / count(*)', 2)} AS avg_30d, min(price) AS min_30d,
    max(price) AS max_30d, count(DISTINCT scraped_date) AS days_30d, any_value(d) AS as_of
  FROM stg, today WHERE scraped_date > d - 30 AND scraped_date <= d GROUP BY product_id""",
)
def latest_features(spark: SparkSession, sf: str) -> DataFrame:
    """The features of the last day, from the table of daily states."""
    base = fresh_dir(spark, "daily")
    daily_table.load_days(staged(spark, sf), base, "all")
    states = daily_table.read_days(spark, base)
    return daily.latest_features(states, states.agg(F.max("scraped_date")).first()[0])


@register(
    "prices_with_metadata",
    f"""WITH {STG}, m AS (SELECT product_id, arg_max(title, (scraped_at, event_id)) FILTER (title IS NOT NULL) AS title,
    arg_max(category, (scraped_at, event_id)) FILTER (category IS NOT NULL) AS category, arg_max(rating, (scraped_at, event_id)) FILTER (rating IS NOT NULL) AS rating,
    arg_max(url, (scraped_at, event_id)) FILTER (url IS NOT NULL) AS url, arg_max(source, (scraped_at, event_id)) FILTER (source IS NOT NULL) AS source
    FROM stg GROUP BY product_id)
  SELECT event_id, product_id, scraped_at, price, currency, m.title, m.category, m.rating, m.url, m.source FROM stg JOIN m USING (product_id)""",
)
def prices_with_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Each price beside the last known metadata of its product, joined by storage layout."""
    name = f"family_{fresh_dir(spark, 'x').rsplit('-', 1)[-1]}"
    families.write_families(staged(spark, sf), name, ["scraped_at", "event_id"], buckets=8)
    return families.prices_with_metadata(spark, name)


# --------------------------------------------------------------------------- cleaning and parsing

register(
    "conform",
    f"""WITH {RAW} SELECT event_id, 'c' || event_id AS title, price, lower(trim(replace(replace(source, '.toscrape.com', '_toscrape'), '.', '_'))) AS source,
  'GBP' AS currency, 'Unknown' AS category, scraped_at, CAST(scraped_at AS DATE) AS scraped_date,
  'c' || event_id || '_' || lower(trim(replace(replace(source, '.toscrape.com', '_toscrape'), '.', '_'))) AS product_id,
  CASE WHEN availability IS NULL THEN 'In stock' WHEN regexp_matches(availability, '^[0-5] ') THEN availability ELSE 'In stock' END AS availability
  FROM raw""",
)(
    lambda s, f: st.conform(
        raw(s, f).select(
            "event_id",
            F.concat(F.lit("c"), "event_id").alias("title"),
            F.col("price").cast("string").alias("price"),
            F.concat(F.lit("  "), F.upper("source"), F.lit(" ")).alias("source"),
            "availability",
            F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("scraped_at"),
        )
    )
)

# Each row writes its price in one of six ways; the last one is no price.
register(
    "parse_prices",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_orderkey % 6 WHEN 3 THEN floor(l_extendedprice)
    WHEN 4 THEN floor(l_extendedprice) WHEN 5 THEN 0 ELSE l_extendedprice END AS local_price, l_extendedprice AS symbol_price
  FROM lineitem""",
)(
    lambda s, f: tables.written_prices(tables.read_lines(s, f)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        p.parse_price_fr("local_text").alias("local_price"),
        p.parse_price_symbol("symbol_text").alias("symbol_price"),
    )
)
register(
    "parse_fields",
    f"""SELECT p_partkey, {rnd('p_size * 2 / 20', 1)} AS stars, CAST(p_size % 5 + 1 AS DOUBLE) AS word_rating,
  p_size / 10 AS label_rating, CASE WHEN p_size % 2 = 0 THEN 'In Stock' ELSE 'Out of Stock' END AS stock,
  upper(p_type[1]) || lower(p_type[2:]) || ' Pc' AS url_category, p_brand AS crumb, p_type AS before_last,
  p_name || ' ' || p_brand AS joined, md5('https://x.example/' || p_partkey) AS product_id FROM part""",
)(
    lambda s, f: tables.read_table(s, f, "part").select(
        "p_partkey",
        p.parse_star_width(F.concat(F.lit("width: "), F.col("p_size") * 2, F.lit("%"))).alias("stars"),
        p.rating_from_word(
            F.concat(F.lit("star-rating "), F.element_at(F.array(*[F.lit(x) for x in ("One", "Two", "Three", "Four", "Five")]), F.col("p_size") % 5 + 1))
        ).alias("word_rating"),
        p.rating_from_label(F.concat((F.col("p_size") / 10).cast("string"), F.lit(" out of 5"))).alias("label_rating"),
        p.stock_from_text(F.when(F.col("p_size") % 2 == 0, " 9 In STOCK").otherwise("gone")).alias("stock"),
        p.category_from_url(F.concat(F.lit("https://x.example/"), F.lower("p_type"), F.lit("-pc/?page=2"))).alias("url_category"),
        p.crumb_at(F.array(F.lit("Home"), F.lit("All"), F.concat(F.lit(" "), "p_brand")), 3).alias("crumb"),
        p.crumb_before_last(F.array(F.lit("Home"), F.col("p_type"), F.lit("x")), F.lit("-")).alias("before_last"),
        p.join_texts(F.array(F.concat(F.lit("\n "), "p_name"), F.lit("  "), F.col("p_brand"))).alias("joined"),
        c.product_id_from_url(F.concat(F.lit("https://x.example/"), F.col("p_partkey").cast("string"))).alias("product_id"),
    )
)
register(
    "text_functions",
    """SELECT doc_id, lang, lower(regexp_replace(coalesce(text, '') || '_' || source, '[^\\p{L}\\p{N}_]+', '_', 'g')) AS surrogate,
  substr(text, 1, 38) AS short, coalesce(nullif(trim(source), ''), lang) AS first_label FROM documents""",
)(
    lambda s, f: tables.read_table(s, f, "documents").select(
        "doc_id", "lang",
        c.surrogate_product_id("text", F.col("source")).alias("surrogate"),
        c.truncate("text", 38).alias("short"),
        c.first_match(F.trim("source"), "lang").alias("first_label"),
    )
)
register(
    "labels_and_verdicts",
    """SELECT event_id, CASE WHEN value <= 20 THEN 'severe' ELSE 'x' END AS sev,
  CASE WHEN value / 100 < 0.05 THEN 'Yes' ELSE 'No' END AS sig,
  CASE WHEN abs(value / 50 - 0.5) >= 0.8 THEN 'large' WHEN abs(value / 50 - 0.5) >= 0.5 THEN 'medium' ELSE 'small' END AS effect,
  CASE WHEN value - 10 > 0 THEN 'Rising' ELSE 'Falling' END AS trend,
  CASE WHEN value / 100 >= 0.05 THEN 'Yes' ELSE 'No' END AS normal FROM events""",
)(
    lambda s, f: tables.read_table(s, f, "events").select(
        "event_id",
        F.when(c.severity(F.col("value") - 40) == "severe", "severe").otherwise("x").alias("sev"),
        c.significant(F.col("value") / 100).alias("sig"),
        c.effect_label(F.col("value") / 50 - 0.5).alias("effect"),
        c.trend_label(F.col("value") - 10).alias("trend"),
        c.normal_verdict(F.col("value") / 100).alias("normal"),
    )
)

REASON = """CASE WHEN title = '' THEN 'missing title' WHEN price IS NULL THEN 'missing price' WHEN url = '' THEN 'missing url'
  WHEN price < 0 THEN 'negative price' END"""
BROKEN = """broken AS (SELECT event_id, product_id, source, CASE WHEN event_id % 11 = 0 THEN '' ELSE url END AS url,
  CASE WHEN event_id % 7 = 0 THEN '' ELSE title END AS title,
  CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 13 = 0 THEN -price ELSE price END AS price, currency, scraped_at FROM raw)"""


def broken(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    return raw(spark, sf).select(
        "event_id", "product_id", "source",
        F.when(e % 11 == 0, "").otherwise(F.col("url")).alias("url"),
        F.when(e % 7 == 0, "").otherwise(F.col("title")).alias("title"),
        F.when(e % 5 == 0, F.lit(None)).when(e % 13 == 0, -F.col("price")).otherwise(F.col("price")).alias("price"),
        "currency", "scraped_at",
    )


register("validate_items", f"WITH {RAW}, {BROKEN} SELECT * FROM broken WHERE {REASON} IS NULL")(
    lambda s, f: st.validate_items(broken(s, f))[0]
)
register("rejected_items", f"WITH {RAW}, {BROKEN} SELECT *, {REASON} AS reject_reason FROM broken WHERE {REASON} IS NOT NULL")(
    lambda s, f: st.validate_items(broken(s, f))[1]
)
register(
    "validate_payload",
    f"""WITH {RAW}, {BROKEN} SELECT *, NULL::DOUBLE AS rating, 'Unknown' AS availability, '' AS category, '' AS image_url,
  'unknown' AS pipeline FROM broken WHERE {REASON} IS NULL""",
)(lambda s, f: st.validate_payload(broken(s, f).withColumn("scraped_at", F.col("scraped_at")))[0])
register(
    "shift_and_default",
    f"""WITH {RAW} SELECT product_id AS id, price AS amount, coalesce(availability, 'Unknown') AS availability,
  'nifi-streaming' AS pipeline, '' AS category, '' AS image_url, NULL::DOUBLE AS rating FROM raw""",
)(
    lambda s, f: st.default_fields(
        st.shift_fields(raw(s, f), {"id": "product_id", "amount": "price", "availability": "availability"}),
        st.STREAM_DEFAULTS,
    )
)
register(
    "sellable",
    f"WITH {RAW}, {BROKEN} SELECT event_id, title, price FROM broken WHERE title <> '' AND price <> 0",
)(lambda s, f: st.sellable(broken(s, f)).select("event_id", "title", "price"))

# --------------------------------------------------------------------------- sources and sinks


# Records as they are sent: broken, refused, without a time, twice, or again from another source.
SENT = """sent AS (SELECT * REPLACE (CASE WHEN copy = 2 THEN 'other.example' ELSE source END AS source,
    CASE WHEN event_id % 101 <> 0 THEN scraped_at END AS scraped_at) FROM (
  SELECT stg.*, raw.availability AS raw_av, CASE WHEN event_id % 83 = 0 THEN '' ELSE stg.title END AS title2,
    CASE WHEN event_id % 89 = 0 THEN -stg.price ELSE stg.price END AS price2, event_id % 97 = 0 AS corrupt,
    unnest(CASE WHEN event_id % 10 = 0 THEN [1, 1] WHEN event_id % 13 = 0 AND event_id % 97 <> 0 THEN [1, 2] ELSE [1] END) AS copy
  FROM stg JOIN raw USING (event_id)))"""
JSON_OK = f"""{STG}, {SENT}, good AS (SELECT product_id, source, url, title2 AS title, price2 AS price, currency, rating,
    nullif(raw_av, '') AS raw_av, scraped_at FROM sent WHERE NOT corrupt AND title2 <> '' AND price2 >= 0)"""


@register(
    "json_records",
    f"""WITH {JSON_OK} SELECT product_id, source, url, title, price, currency, rating, scraped_at FROM (
  SELECT DISTINCT * FROM good WHERE scraped_at IS NOT NULL)""",
)
def json_records(spark: SparkSession, sf: str) -> DataFrame:
    """Write JSON lines, read them back, set aside what is broken, load the rest once."""
    base = fresh_dir(spark, "jsonl")
    tables.json_texts(tables.read_table(spark, sf, "events")).write.text(f"{base}/in/a.jsonl")
    good, _ = files.split_corrupt(files.read_observations(spark, f"{base}/in"))
    valid, _ = st.validate_items(good)
    files.load_raw(valid, f"{base}/raw")
    files.load_raw(valid, f"{base}/raw")
    return spark.read.parquet(f"{base}/raw").select(
        "product_id", "source", "url", "title", "price", "currency", "rating", "scraped_at"
    )


@register(
    "write_jsonl",
    f"WITH {STG} SELECT product_id, source, url, title, price, currency, rating, availability, category, image_url, scraped_at FROM stg",
)
def jsonl_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    base = fresh_dir(spark, "out")
    files.write_jsonl(staged(spark, sf).select(*PRICE_COLUMNS), base)
    return files.split_corrupt(files.read_observations(spark, base))[0]


register(
    "topic_messages",
    f"WITH {RAW} SELECT product_id AS key, source, price FROM raw WHERE source = 'jumia.ma'",
)(
    lambda s, f: kafka.to_messages(raw(s, f), "jumia.ma").select("key", F.from_json("value", PRICE_SCHEMA).alias("r")).select(
        "key", "r.source", "r.price"
    )
)
register(
    "parse_messages",
    f"WITH {STG} SELECT product_id, price, scraped_at FROM stg",
)(
    lambda s, f: kafka.parse_messages(kafka.to_messages(staged(s, f)).select(F.col("value").cast("binary").alias("value"))).select(
        "product_id", "price", "scraped_at"
    )
)

WIDE = STG + """, wide AS (SELECT product_id || '#' || lpad(CAST(9223372036854775807 - epoch_us(scraped_at) // 1000 AS VARCHAR), 19, '0') AS row_key, * FROM stg)"""


BUCKETS = 8


@register("wide_table_ddl", f"WITH {WIDE} SELECT 0::BIGINT AS created_with, count(DISTINCT row_key) AS rows, false AS there_after FROM wide")
def wide_table_ddl(spark: SparkSession, sf: str) -> DataFrame:
    """The table is made once however often it is asked for, holds what is written to its folder, and goes."""
    path = fresh_dir(spark, "ddl")
    name = f"wide_{path.rsplit('-', 1)[-1]}"
    widerow.create_table(spark, name, path)
    widerow.create_table(spark, name, path)
    before = spark.table(name).count()
    widerow.upsert_wide_row(staged(spark, sf), path, buckets=BUCKETS)
    spark.catalog.recoverPartitions(name)
    rows = spark.table(name).select("row_key").distinct().count()
    widerow.drop_table(spark, name)
    widerow.drop_table(spark, name)
    row = (before, rows, spark.catalog.tableExists(name))
    return spark.createDataFrame([row], "created_with long, rows long, there_after boolean")


def wide_table(spark: SparkSession, sf: str) -> DataFrame:
    """Written twice: the second version of each key must win."""
    path = fresh_dir(spark, "wide")
    rows = staged(spark, sf)
    widerow.upsert_wide_row(rows.withColumn("price", F.lit(1.0)), path, F.lit("2024-01-01").cast("timestamp"), BUCKETS)
    widerow.upsert_wide_row(rows, path, F.lit("2024-01-02").cast("timestamp"), BUCKETS)
    return widerow.read_rows(spark, path)


register(
    "wide_row_table",
    f"WITH {WIDE} SELECT row_key, price, currency, availability, title, source, url, coalesce(category, '') AS category, rating FROM wide",
)(
    lambda s, f: widerow.decode_wide_row(h.latest_version(wide_table(s, f))).select(
        "row_key", "price", "currency", "availability", "title", "source", "url", "category", "rating"
    )
)
register("wide_row_history", f"WITH {WIDE} SELECT row_key, price, rating FROM wide WHERE product_id = 'p8' ORDER BY row_key LIMIT 100")(
    lambda s, f: widerow.product_history(wide_table(s, f), "p8", buckets=BUCKETS).select("row_key", "price", "rating")
)
register("wide_row_latest", f"WITH {WIDE} SELECT row_key, price FROM wide WHERE product_id = 'p8' ORDER BY row_key LIMIT 1")(
    lambda s, f: widerow.latest_price(wide_table(s, f), "p8", BUCKETS).select("row_key", "price")
)
register("wide_row_scan", f"WITH {WIDE} SELECT row_key, price FROM wide ORDER BY row_key LIMIT 1000")(
    lambda s, f: widerow.scan_all(wide_table(s, f), 1000).select("row_key", "price")
)


def missing_table(spark: SparkSession) -> DataFrame:
    return spark.table("no_such_table")


register("first_available", f"WITH {STG} SELECT product_id, price FROM stg")(
    lambda s, f: files.first_available(
        [lambda: missing_table(s), lambda: staged(s, f).where(F.col("price") < 0), lambda: staged(s, f)]
    ).select("product_id", "price")
)

ITEM = "product_id, source, url, title, price, currency, rating, availability, category, image_url, scraped_at"


def item_sql(base: str, where: str = "TRUE", **cols: str) -> str:
    return f"SELECT {', '.join(f'{cols[x]} AS {x}' for x in PRICE_COLUMNS)} FROM {base} WHERE {where}"


def page_query(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda s, f: pages.extract_products(build(tables.read_table(s, f, "part")))


FETCHED = f"TIMESTAMP '{tables.FETCHED}'"
register("pages_listing", item_sql(
    "part", product_id="md5('https://www.jumia.ma/item-' || p_partkey || '.html')", source="'jumia.ma'",
    url="'https://www.jumia.ma/item-' || p_partkey || '.html'", title="p_name", price=rnd("p_retailprice", 2), currency="'MAD'",
    rating=rnd("p_size * 2 / 20", 1), availability="CASE WHEN p_size % 5 = 0 THEN 'Out of Stock' ELSE 'In Stock' END",
    category="'Pc ' || upper(p_type[1]) || lower(p_type[2:])", image_url="'https://img.jumia.ma/' || p_partkey || '.jpg'",
    scraped_at=FETCHED))(page_query(tables.listing_pages))
register("pages_two_step", item_sql(
    "part", "p_partkey % 7 <> 0", product_id="md5('https://www.ultrapc.ma/parts/' || p_partkey || '.html')", source="'ultrapc.ma'",
    url="'https://www.ultrapc.ma/parts/' || p_partkey || '.html'", title="p_name", price=rnd("p_retailprice", 2), currency="'MAD'",
    rating="NULL::DOUBLE", availability="CASE WHEN p_partkey % 5 = 0 THEN 'Out of Stock' ELSE 'In Stock' END", category="p_type",
    image_url="'https://www.ultrapc.ma/img/' || CASE WHEN p_partkey % 4 = 0 THEN 'hi-' ELSE '' END || p_partkey || '.jpg'",
    scraped_at=FETCHED))(page_query(tables.shop_pages))
register("pages_books", item_sql(
    "part", product_id="md5('https://books.toscrape.com/catalogue/b_' || p_partkey || '/index.html')", source="'books.toscrape.com'",
    url="'https://books.toscrape.com/catalogue/b_' || p_partkey || '/index.html'", title="p_name", price=rnd("p_retailprice", 2),
    currency="'GBP'", rating="CAST(p_size % 5 + 1 AS DOUBLE)", availability="'In stock'", category="p_type",
    image_url="'https://books.toscrape.com/media/' || p_partkey || '.jpg'", scraped_at=FETCHED))(page_query(tables.book_pages))
register("pages_shop_detail", item_sql(
    "part", product_id="md5('https://scrapeme.live/shop/' || p_partkey || '/')", source="'scrapeme.live'",
    url="'https://scrapeme.live/shop/' || p_partkey || '/'", title="p_name", price=rnd("p_retailprice", 2), currency="'GBP'",
    rating="p_size / 10", availability="CASE WHEN p_partkey % 2 = 0 THEN 'In Stock' ELSE 'Out of Stock' END", category="p_type",
    image_url="'https://scrapeme.live/f/' || p_partkey || '.png'", scraped_at=FETCHED))(page_query(tables.shop_detail_pages))
@register("pages_without_products", "SELECT count(*) AS pages, 0::BIGINT AS products FROM pages")
def pages_without_products(spark: SparkSession, sf: str) -> DataFrame:
    """Every given page is read in the one-step listing layout: they are articles, so no product is found."""
    given = tables.read_table(spark, sf, "pages")
    found = pages.extract_products(
        given.select("url", "html", F.lit(tables.FETCHED).cast("timestamp").alias("fetched_at"), F.lit("jumia.ma").alias("site"))
    )
    return given.agg(F.count(F.lit(1)).alias("pages")).join(found.agg(F.count(F.lit(1)).alias("products")))


LINK = "regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)"


def marked(tag: str) -> str:
    """Text of an element with the character references that the pages use resolved."""
    text = f"trim(regexp_extract(html, '<{tag}>([^<]*)</{tag}>', 1), ' ' || chr(9) || chr(10))"
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{char}')"
    return text


register("pages_articles", f"""SELECT page_id, url, coalesce({marked('title')}, '') AS title, coalesce({marked('h1')}, '') AS heading,
  coalesce(len({LINK}), 0)::BIGINT AS n_links, regexp_extract(url, '^[a-z]+://[^/?]*', 0) || {LINK}[1] AS first_link FROM pages""")(
    lambda s, f: pages.extract_articles(tables.read_table(s, f, "pages")).select(
        "page_id", "url", "title", "heading", F.size("links").cast("long").alias("n_links"), F.try_element_at("links", F.lit(1)).alias("first_link")
    )
)

# --------------------------------------------------------------------------- reading the marts

register("search_products", f"""WITH {CUR} SELECT {CUR_COLS} FROM cur WHERE source = 'jumia.ma'
  AND (contains(lower(title), '1') OR contains(lower(coalesce(category, '')), '1')) AND price BETWEEN 5 AND 80""")(
    lambda s, f: sv.search(current(s, f), source="jumia.ma", text="1", price_between=(5, 80))
)
register("search_text", f"""WITH {CUR} SELECT {CUR_COLS} FROM cur
  WHERE contains(lower(title), 'cat 2') OR contains(lower(coalesce(category, '')), 'cat 2')""")(
    lambda s, f: sv.search(current(s, f), text="CAT 2")
)
register("search_title", f"WITH {CUR} SELECT {CUR_COLS} FROM cur WHERE contains(lower(title), 'duct 1') AND availability = 'In stock'")(
    lambda s, f: sv.search(current(s, f), title="DUCT 1", availability="In stock")
)
register("sorted_products", f"WITH {CUR} SELECT {CUR_COLS} FROM cur")(
    lambda s, f: sv.sort_products(current(s, f), "rating_desc")
)
register("product_page", f"""WITH {CUR} SELECT {CUR_COLS}, (SELECT count(*) FROM cur) AS total FROM cur
  ORDER BY source, title, product_id LIMIT 20 OFFSET 10""")(lambda s, f: sv.page_with_total(current(s, f), 20, 10))
ORDERS = {"price_asc": "price ASC", "price_desc": "price DESC", "rating_desc": "rating DESC", "title_asc": "title ASC"}


@register(
    "sorted_products",
    f"WITH {CUR}" + " UNION ALL ".join(
        f" SELECT '{key}' AS sort_key, product_id, row_number() OVER (ORDER BY {order} NULLS LAST, product_id) AS position FROM cur" for key, order in ORDERS.items()
    ),
)
def sorted_products(spark: SparkSession, sf: str) -> DataFrame:
    """The place of every product in each of the four orders, read off the sorted rows as they come."""
    rows = stash(current(spark, sf), "current")
    in_order = Window.orderBy("_at")
    parts = [
        sv.sort_products(rows, key).select("product_id", F.monotonically_increasing_id().alias("_at")).select(
            F.lit(key).alias("sort_key"), "product_id", F.row_number().over(in_order).cast("long").alias("position")
        )
        for key in ORDERS
    ]
    return reduce(DataFrame.unionByName, parts)


register("product_lookup", f"WITH {CUR} SELECT {CUR_COLS} FROM cur WHERE product_id = 'p8'")(
    lambda s, f: sv.get_product(current(s, f), "p8")
)
register("product_history", f"""WITH {CHG} SELECT {HIST_COLS} FROM chg WHERE product_id = 'p8'
  AND scraped_date >= (SELECT max(scraped_date) FROM stg) - INTERVAL 14 DAY""")(
    lambda s, f: sv.product_history(m.price_history(changes(s, f)), "p8", 14, last_day(s, f))
)
register("alerts_at_least", f"WITH {ALERTS} SELECT * FROM alerts WHERE price_change_pct <= -20 AND source = 'jumia.ma'")(
    lambda s, f: sv.alerts_at_least(alerts(s, f), 20, "jumia.ma")
)
register("distinct_sources", f"WITH {STG} SELECT DISTINCT source FROM stg")(lambda s, f: sv.distinct_values(staged(s, f)))
register("live_kpis", f"""WITH {CUR} SELECT count(*) AS products, count(DISTINCT source) AS sources,
  {rnd('avg(price)', 2)} AS avg_price, min(price) AS lowest, max(price) AS highest FROM cur""")(
    lambda s, f: sv.live_kpis(current(s, f))
)
register("market_share", f"""WITH {CUR} SELECT source, count(*) AS n,
  {rnd('count(*) / (SELECT count(*) FROM cur) * 100', 2)} AS share_pct FROM cur GROUP BY source""")(
    lambda s, f: sv.market_share(current(s, f))
)
register("alert_kpis", f"""WITH {ALERTS} SELECT count(*) AS alerts, min(price_change_pct) AS biggest_drop,
  count(DISTINCT source) AS sources_hit, count(*) FILTER (WHERE price_change_pct <= -20) AS severe FROM alerts""")(
    lambda s, f: sv.alert_kpis(alerts(s, f))
)
SEVERITY = "CASE WHEN price_change_pct <= -20 THEN 'severe' WHEN price_change_pct <= -10 THEN 'moderate' ELSE 'mild' END"
register("severity_distribution", f"WITH {ALERTS} SELECT {SEVERITY} AS severity, count(*) AS n FROM alerts GROUP BY 1")(
    lambda s, f: sv.severity_distribution(alerts(s, f))
)
register("top_drops", f"""WITH {ALERTS} SELECT * REPLACE (substr(coalesce(title, product_id), 1, 62) AS title), {SEVERITY} AS severity
  FROM alerts ORDER BY price_change_pct, product_id, scraped_at LIMIT 12""")(lambda s, f: sv.top_drops(alerts(s, f)))
register("market_totals", f"""WITH {DED} SELECT CAST(sum(product_count) AS BIGINT) AS total_products,
  CAST(sum(observation_count) AS BIGINT) AS total_observations, count(*) AS markets FROM ({STATS_SELECT})""")(
    lambda s, f: sv.market_totals(m.price_stats(deduped(s, f)))
)
register("period_summary", f"""WITH {DED}, p AS (SELECT product_id, max(price) AS high, min(price) AS low,
    arg_min(price, scraped_at) AS first_price, arg_max(price, scraped_at) AS current_price FROM ded GROUP BY 1)
  SELECT *, {rnd('current_price - first_price', 2)} AS change_abs,
    CASE WHEN first_price <> 0 THEN {rnd('(current_price - first_price) / first_price * 100', 2)} END AS change_pct FROM p""")(
    lambda s, f: sv.period_summary(deduped(s, f))
)
register("product_labels", f"WITH {DED} SELECT product_id, arg_min(title, scraped_at) AS label FROM ded GROUP BY 1")(
    lambda s, f: sv.product_labels(deduped(s, f))
)
register("flag_drops", f"""WITH {CHG} SELECT product_id, scraped_at, price, coalesce(price_change_pct <= -5, false) AS is_drop
  FROM chg WHERE product_id = 'p8'""")(
    lambda s, f: sv.flag_drops(m.price_history(changes(s, f)))
    .where(F.col("product_id") == "p8")
    .select("product_id", "scraped_at", "price", "is_drop")
)
register("price_ranges", f"""WITH {DED}, stats AS ({STATS_SELECT}) SELECT source, currency, 'Min' AS metric, min_price AS price FROM stats
  UNION ALL SELECT source, currency, 'Avg', avg_price FROM stats UNION ALL SELECT source, currency, 'Median', median_price FROM stats
  UNION ALL SELECT source, currency, 'Max', max_price FROM stats""")(lambda s, f: sv.price_ranges(m.price_stats(deduped(s, f))))
register("product_table", f"WITH {CUR} SELECT title, source, price, currency, availability, category, rating, scraped_at FROM cur")(
    lambda s, f: sv.product_table(current(s, f))
)
register("source_labels", f"""WITH {DED} SELECT product_id, scraped_at, CASE source WHEN 'jumia.ma' THEN 'JUMIA.MA'
  WHEN 'ultrapc.ma' THEN 'ULTRAPC.MA' ELSE '?' END AS label FROM ded""")(
    lambda s, f: sv.with_source_label(
        deduped(s, f),
        sv.distinct_values(staged(s, f)).where(F.col("source").isin("jumia.ma", "ultrapc.ma")).withColumn("label", F.upper("source")),
    ).select("product_id", "scraped_at", "label")
)
register("last_non_null", f"""WITH {STG} SELECT product_id, arg_max(price, scraped_at) AS price,
  arg_max(category, scraped_at) FILTER (WHERE category IS NOT NULL) AS category,
  arg_max(image_url, scraped_at) FILTER (WHERE image_url IS NOT NULL) AS image_url FROM stg GROUP BY 1""")(
    lambda s, f: h.last_non_null(staged(s, f), ["product_id"], ["scraped_at", "event_id"]).select(
        "product_id", "price", "category", "image_url"
    )
)
register("latest_row", f"""WITH {STG} SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY source, category
  ORDER BY scraped_at DESC, event_id DESC) AS rn FROM stg) WHERE rn = 1""")(
    lambda s, f: h.latest_row(staged(s, f), ["source", "category"], tables.EVENT_TIE)
)

# --------------------------------------------------------------------------- descriptive statistics

QUART = f"{rnd(pctl('price', 0.25), 2)} AS q25, {rnd(pctl('price', 0.75), 2)} AS q75"
# Compensated sums: means that end in exactly half a cent must not depend on the order of rows.
MEAN2, STD2 = f"{rnd('favg(price)', 2)} AS mean", f"{rnd('stddev_samp(price)', 2)} AS std"
MEDIAN2 = f"{rnd(pctl('price', 0.5), 2)} AS median"

register("fallback_stats", f"""WITH {STG} SELECT source, currency, count(price) AS product_count, {rnd('avg(price)', 2)} AS avg_price,
  min(price) AS min_price, max(price) AS max_price, {rnd(pctl('price', 0.5), 2)} AS median_price,
  {rnd('stddev_samp(price)', 2)} AS stddev_price FROM stg GROUP BY 1, 2""")(lambda s, f: d.fallback_stats(staged(s, f)))
CENTRAL = """SELECT {g} AS source, count(*) AS n, {mean}, {median}, (SELECT price FROM pos p WHERE {same} GROUP BY price
    ORDER BY count(*) DESC, price LIMIT 1) AS mode, {geo} AS geometric_mean FROM pos o {by}"""
register("central_tendency", "WITH " + STG + " " + CENTRAL.format(
    g="source", mean=MEAN2, median=MEDIAN2, same="p.source = o.source", geo=rnd("exp(avg(ln(price)))", 2), by="GROUP BY source")
    + " UNION ALL " + CENTRAL.format(g=f"'{d.OVERALL}'", mean=MEAN2, median=MEDIAN2, same="true", geo=rnd("exp(avg(ln(price)))", 2), by=""))(
    lambda s, f: d.central_tendency(positive(s, f))
)
register("dispersion", f"""WITH {STG} SELECT source, {STD2}, {rnd('var_samp(price)', 2)} AS variance, {QUART},
  {rnd(f"({pctl('price', 0.75)}) - ({pctl('price', 0.25)})", 2)} AS iqr, {rnd('max(price) - min(price)', 2)} AS range_,
  {rnd('stddev_samp(price) / avg(price) * 100', 1)} AS cv_pct FROM pos GROUP BY source""")(lambda s, f: d.dispersion(positive(s, f)))


def moments_sql(by: str) -> str:
    return f"(SELECT {by}, avg(price) AS mu FROM pos GROUP BY {by})"


SKEW3 = rnd("avg((price - mu) ** 3) / nullif(avg((price - mu) ** 2) ** 1.5, 0)", 3)
KURT3 = rnd("avg((price - mu) ** 4) / nullif(avg((price - mu) ** 2) ** 2, 0) - 3", 3)
register("shape", f"""WITH {STG} SELECT source, count(price) AS n, {SKEW3} AS skewness, {KURT3} AS kurtosis
  FROM pos JOIN {moments_sql('source')} USING (source) GROUP BY source""")(lambda s, f: d.shape(positive(s, f)))
register("category_summary", f"""WITH {STG} SELECT category, count(price) AS n, {MEAN2}, {MEDIAN2}, {STD2}, {QUART}
  FROM pos WHERE category IS NOT NULL GROUP BY category""")(lambda s, f: d.category_summary(positive(s, f)))
register("full_summary", f"""WITH {STG}, mo AS (SELECT source, category, avg(price) AS mu FROM pos GROUP BY 1, 2)
  SELECT pos.source, pos.category, count(price) AS count, {MEAN2}, {MEDIAN2}, {STD2}, min(price) AS min, max(price) AS max,
  {QUART}, {SKEW3} AS skewness FROM pos JOIN mo ON pos.source = mo.source AND pos.category = mo.category
  GROUP BY 1, 2""")(lambda s, f: d.full_summary(positive(s, f)))
register("describe_prices", f"""WITH {STG} SELECT source, count(price) AS n, {MEAN2}, {MEDIAN2}, {STD2}, min(price) AS min,
  max(price) AS max, {QUART}, {SKEW3} AS skew, {KURT3} AS kurt FROM pos JOIN {moments_sql('source')} USING (source)
  GROUP BY source""")(lambda s, f: d.describe_prices(positive(s, f)))
CATS = [f"Cat {x}" for x in range(6)]
register("median_pivot", f"WITH {STG} SELECT source, " + ", ".join(
    rnd(pctl("price", 0.5, f" FILTER (WHERE category = '{x}')"), 2) + f' AS "{x}"' for x in CATS) + " FROM pos GROUP BY source")(
    lambda s, f: d.median_pivot(positive(s, f).where("category IS NOT NULL"))
)
register("daily_average", f"""WITH {STG} SELECT scraped_date, source, {rnd('avg(price)', 6)} AS avg_price, count(price) AS n
  FROM pos GROUP BY 1, 2""")(lambda s, f: d.daily_average(positive(s, f), digits=6))
register("daily_volume", f"WITH {STG} SELECT scraped_date, count(*) AS records FROM pos GROUP BY 1")(
    lambda s, f: d.daily_volume(positive(s, f))
)
OBSERVED = STG + """, obs AS (SELECT *, (price - prev_price) / prev_price * 100 AS pct_change FROM (
    SELECT *, lag(price) OVER (PARTITION BY product_id ORDER BY scraped_at, event_id) AS prev_price FROM pos)),
  ok AS (SELECT * FROM obs WHERE abs(pct_change) < 200)"""
register("observed_changes", f"WITH {OBSERVED} SELECT event_id, price, prev_price, {rnd('pct_change', 6)} AS pct_change FROM ok")(
    lambda s, f: d.observed_changes(narrow(positive(s, f)), tables.EVENT_TIE).select(
        "event_id", "price", "prev_price", F.round("pct_change", 6).alias("pct_change")
    )
)
register("lag_price_in_spans", f"WITH {OBSERVED} SELECT event_id, prev_price FROM obs")(
    # Every product with more than three rows goes through the path for hot products.
    lambda s, f: h.lag_price(positive(s, f), ["scraped_at", "event_id"], partitions=16).select("event_id", "prev_price")
)
register("change_volatility", f"""WITH {OBSERVED} SELECT source, {rnd('avg(pct_change)', 3)} AS mean_chg,
  {rnd('stddev_samp(pct_change)', 3)} AS std_chg, {rnd('avg(CASE WHEN pct_change < -5 THEN 1.0 ELSE 0.0 END) * 100', 1)} AS pct_drops,
  {rnd('avg(CASE WHEN pct_change > 5 THEN 1.0 ELSE 0.0 END) * 100', 1)} AS pct_spikes FROM ok GROUP BY source""")(
    lambda s, f: d.change_volatility(d.observed_changes(narrow(positive(s, f)), tables.EVENT_TIE))
)


def fence_ctes(by: str = "source", k: float = 1.5) -> str:
    return f"""lim AS (SELECT {by}, q1, q2, q3, mu, sd, n, q1 - {k} * (q3 - q1) AS lower, q3 + {k} * (q3 - q1) AS upper FROM (
    SELECT {by}, {pctl('price', 0.25)} AS q1, {pctl('price', 0.5)} AS q2, {pctl('price', 0.75)} AS q3, avg(price) AS mu, stddev_pop(price) AS sd,
    count(*) AS n FROM pos GROUP BY {by}))"""


OUTLIERS = f"""SELECT source, any_value(n) AS n, count(*) FILTER (WHERE price < lower OR price > upper) AS iqr_outliers,
  {rnd('count(*) FILTER (WHERE price < lower OR price > upper) / any_value(n) * 100', 1)} AS iqr_pct,
  count(*) FILTER (WHERE abs((price - mu) / sd) > 3) AS z_outliers,
  {rnd('count(*) FILTER (WHERE abs((price - mu) / sd) > 3) / any_value(n) * 100', 1)} AS z_pct,
  {rnd('any_value(lower)', 2)} AS lower_fence, {rnd('any_value(upper)', 2)} AS upper_fence
  FROM pos JOIN lim USING (source) GROUP BY source"""
register("outlier_summary", f"WITH {STG}, {fence_ctes()} {OUTLIERS}")(lambda s, f: d.outlier_summary(positive(s, f)))
register("lineitem_outlier_summary", f"WITH {LINES}, pos AS (SELECT * FROM lines WHERE price > 0), {fence_ctes()} {OUTLIERS}")(
    lambda s, f: d.outlier_summary(st.positive_price(lines(s, f)))
)
register("zscores", f"WITH {STG}, {fence_ctes()} SELECT event_id, {rnd('(price - mu) / sd', 6)} AS z FROM pos JOIN lim USING (source)")(
    lambda s, f: d.with_zscore(positive(s, f)).select("event_id", F.round("z", 6).alias("z"))
)
register("cv_ranking", f"WITH {STG} SELECT source, {rnd('stddev_samp(price) / avg(price) * 100', 1)} AS cv FROM pos GROUP BY source")(
    lambda s, f: d.cv_ranking(positive(s, f))
)


def hist_sql(value: str, bins: int, lo: str, hi: str, where: str = "true") -> str:
    return f"""SELECT source, bin, count(*) AS n, {rnd(f'any_value(lo + bin * (hi - lo) / {bins})', 6)} AS bin_start FROM (
    SELECT source, lo, hi, CAST(least(floor(({value} - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INTEGER) AS bin
    FROM x, (SELECT {lo} AS lo, {hi} AS hi FROM x) WHERE {where}) GROUP BY 1, 2"""


def hist(df: DataFrame) -> DataFrame:
    return df.select("source", "bin", "n", F.round("bin_start", 6).alias("bin_start"))


register("histogram", f"WITH {STG}, x AS (SELECT * FROM pos) " + hist_sql("price", 60, "min(price)", "max(price)"))(
    lambda s, f: hist(d.histogram(positive(s, f)))
)
register("log_histogram", f"WITH {STG}, x AS (SELECT * FROM pos) " + hist_sql("log10(price)", 55, "min(log10(price))", "max(log10(price))"))(
    lambda s, f: hist(d.histogram(positive(s, f), bins=55, log=True))
)
register("change_histogram", f"WITH {OBSERVED}, x AS (SELECT * FROM ok) "
         + hist_sql("pct_change", 80, "any_value(-50.0::DOUBLE)", "any_value(50.0::DOUBLE)", "pct_change BETWEEN -50 AND 50"))(
    lambda s, f: hist(d.histogram(d.observed_changes(narrow(positive(s, f)), tables.EVENT_TIE), "pct_change", 80, span=(-50, 50)))
)
register("box_stats", f"""WITH {STG}, {fence_ctes()} SELECT source, any_value(q1) AS q25, any_value(q2) AS median, any_value(q3) AS q75,
  min(price) FILTER (WHERE price BETWEEN lower AND upper) AS whisker_low,
  max(price) FILTER (WHERE price BETWEEN lower AND upper) AS whisker_high,
  count(*) FILTER (WHERE NOT price BETWEEN lower AND upper) AS n_outliers FROM pos JOIN lim USING (source) GROUP BY source""")(
    lambda s, f: d.box_stats(positive(s, f))
)
register("box_outliers", f"WITH {STG}, {fence_ctes()} SELECT source, event_id, price FROM pos JOIN lim USING (source) WHERE price < lower OR price > upper")(
    lambda s, f: d.box_outliers(positive(s, f).select("source", "event_id", "price"))
)
register("density_grid", f"""WITH {STG}, lim AS (SELECT source, n, lo, hi, 1.059 * least(sd, (q3 - q1) / 1.349) * power(n, -0.2) AS h FROM (
    SELECT source, count(*) AS n, min(price) AS lo, max(price) AS hi, stddev_samp(price) AS sd, {pctl('price', 0.25)} AS q1,
    {pctl('price', 0.75)} AS q3 FROM pos GROUP BY source)),
  bins AS (SELECT source, least(floor((price - lo) / ((hi - lo) / 200)), 199) AS bin, count(*) AS m FROM pos JOIN lim USING (source) GROUP BY 1, 2),
  grid AS (SELECT unnest(range(0, 64)) AS point)
  SELECT source, CAST(point AS INTEGER) AS point, {rnd('any_value(lo + point * (hi - lo) / 63)', 6)} AS x,
    {rnd('sum(m * exp(-0.5 * ((((lo + point * (hi - lo) / 63) - (lo + (bin + 0.5) * ((hi - lo) / 200))) / h) ** 2)) / sqrt(2 * pi()) / (n * h))', 8)} AS density
  FROM bins JOIN lim USING (source), grid GROUP BY 1, 2""")(
    lambda s, f: d.density_grid(positive(s, f)).select(
        "source", "point", F.round("x", 6).alias("x"), F.round("density", 8).alias("density")
    )
)
register("top_categories", f"""WITH {STG} SELECT category, count(*) AS n FROM pos WHERE category IS NOT NULL GROUP BY 1
  ORDER BY n DESC, category LIMIT 3""")(lambda s, f: d.top_categories(positive(s, f), 3))
register("in_top_categories", f"""WITH {STG} SELECT event_id, category FROM pos WHERE category IN (SELECT category FROM pos
  WHERE category IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, category LIMIT 3)""")(
    lambda s, f: d.in_top_categories(positive(s, f), 3).select("event_id", "category")
)
SEVEN = {"p01": 0.01, "p10": 0.1, "q25": 0.25, "median": 0.5, "q75": 0.75, "p90": 0.9, "p99": 0.99}
SEVEN_SQL = ", ".join(f"{rnd(pctl('price', v), 4)} AS {n}" for n, v in SEVEN.items())


def four(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(x, 4).alias(x) if x in SEVEN else x for x in df.columns])


register("quantiles", f"WITH {STG} SELECT source, category, {SEVEN_SQL} FROM pos GROUP BY 1, 2")(
    lambda s, f: four(quantiles(positive(s, f), ["source", "category"], "price", SEVEN))
)


def bucket_quantiles(df: DataFrame, by: list[str], len_bucket: int = 500) -> DataFrame:
    """The path for columns with very many distinct values, forced on."""
    return four(quantiles(df, by, "price", SEVEN, few=0, per_bucket=len_bucket))


register("quantiles_by_bucket", f"WITH {STG} SELECT source, category, {SEVEN_SQL} FROM pos GROUP BY 1, 2")(
    lambda s, f: bucket_quantiles(positive(s, f), ["source", "category"])
)
register("lineitem_quantiles", f"WITH {LINES} SELECT source, {SEVEN_SQL} FROM lines GROUP BY 1")(
    lambda s, f: bucket_quantiles(lines(s, f), ["source"], 20_000)
)
register("sample_per_group", f"""WITH {STG} SELECT source, event_id, price FROM (SELECT *, row_number() OVER (PARTITION BY source
  ORDER BY CAST('0x' || substr(md5('42|' || event_id), 1, 13) AS BIGINT), event_id) AS rn FROM pos) WHERE rn <= 100""")(
    lambda s, f: sampling.sample_per_group(positive(s, f).select("source", "event_id", "price"), "source", ["event_id"], 100)
)
register("salted_join", f"WITH {STG} SELECT event_id, mu FROM (SELECT event_id, source FROM pos) JOIN (SELECT source, max(price) AS mu FROM pos GROUP BY 1) USING (source)")(
    lambda s, f: salted_join(
        positive(s, f).select("event_id", "source"), positive(s, f).groupBy("source").agg(F.max("price").alias("mu")), ["source"]
    ).select("event_id", "mu")
)

register(
    "median_blocks",
    f"""WITH {LINES}, m AS (SELECT source, l_orderkey::VARCHAR AS label, {pctl('price', 0.5)} AS med FROM lines GROUP BY 1, 2),
  b AS (SELECT greatest(1, ceil(count(DISTINCT label) / 1000))::BIGINT AS blocks FROM m)
  SELECT source, (CAST('0x' || substr(md5(label), 1, 8) AS BIGINT) % blocks)::INTEGER AS block, count(*) AS labels,
    string_agg(label || ':' || CAST(round({rnd('med', 2)} * 100) AS BIGINT), ' ' ORDER BY label) AS cells FROM m, b GROUP BY 1, 2""",
)(
    # As many labels as there are orders: more than spark.sql.pivotMaxValues already on small tables.
    lambda s, f: d.median_blocks(lines(s, f).withColumn("label", F.col("l_orderkey").cast("string")), "source", "label").select(
        "source", "block", F.size("cells").cast("long").alias("labels"),
        F.array_join(F.transform(F.map_entries("cells"), lambda e: F.concat_ws(":", e.key, F.round(e.value * 100).cast("long"))), " ").alias("cells"),
    )
)
register("in_top_by_median", f"""WITH {STG} SELECT event_id, category FROM pos WHERE category IN (SELECT category FROM pos
  WHERE category IS NOT NULL GROUP BY 1 ORDER BY {rnd(pctl('price', 0.5), 2)} DESC, category LIMIT 3)""")(
    lambda s, f: d.in_top_categories(positive(s, f), 3, by_median=True).select("event_id", "category")
)
register("top_by_median", f"""WITH {STG} SELECT category, count(*) AS n, {rnd(pctl('price', 0.5), 2)} AS median FROM pos WHERE category IS NOT NULL GROUP BY 1
  ORDER BY median DESC, category LIMIT 3""")(lambda s, f: d.top_by_median(positive(s, f), 3))

# --------------------------------------------------------------------------- tests and regressions


def p6(df: DataFrame) -> DataFrame:
    return df.withColumn("p_value", F.round("p_value", 6))


MOM = STG + """, mom AS (SELECT source, count(*) AS n, avg(price) AS mean, var_samp(price) AS var FROM pos GROUP BY source),
  pr AS (SELECT a.source AS source_a, b.source AS source_b, a.n AS n_a, b.n AS n_b, a.mean AS mean_a, b.mean AS mean_b,
    a.var AS var_a, b.var AS var_b FROM mom a JOIN mom b ON a.source < b.source)"""
register("welch_t", f"""WITH {MOM}, t AS (SELECT *, (mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b) AS t,
    (var_a / n_a + var_b / n_b) ** 2 / ((var_a / n_a) ** 2 / (n_a - 1) + (var_b / n_b) ** 2 / (n_b - 1)) AS df FROM pr),
  s AS (SELECT *, {sql_t_p('t', 'df')} AS p FROM t)
  SELECT source_a, source_b, {rnd('mean_a', 2)} AS mean_a, {rnd('mean_b', 2)} AS mean_b, {rnd('mean_a - mean_b', 2)} AS mean_diff,
    {rnd('t', 4)} AS t_stat, {rnd('p', 6)} AS p_value, CASE WHEN p < 0.05 THEN 'Yes' ELSE 'No' END AS significant FROM s""")(
    lambda s, f: i.welch_t(positive(s, f))
)


def anova_sql(rows: str, group: str, value: str, eta: bool = True) -> str:
    return f"""SELECT k, n, {rnd('f', 4)} AS f_stat, {rnd(sql_f_p('f', '(k - 1)', '(n - k)'), 6)} AS p_value
    {", " + rnd('ssb / (ssb + ssw)', 4) + " AS eta_sq" if eta else ""} FROM (
    SELECT *, (ssb / (k - 1)) / (ssw / (n - k)) AS f FROM (
      SELECT count(*) AS k, CAST(sum(n) AS BIGINT) AS n, sum(n * (mean - grand) ** 2) AS ssb, sum((n - 1) * var) AS ssw FROM (
        SELECT {group}, count(*) AS n, avg({value}) AS mean, coalesce(var_samp({value}), 0) AS var,
          (SELECT avg({value}) FROM {rows}) AS grand FROM {rows} GROUP BY {group})))"""


register("anova", f"WITH {STG} {anova_sql('pos', 'source', 'price')}")(lambda s, f: p6(i.anova(positive(s, f))))
register("levene", f"""WITH {STG}, med AS (SELECT source, {pctl('price', 0.5)} AS med FROM pos GROUP BY source),
  away AS (SELECT source, abs(price - med) AS away FROM pos JOIN med USING (source)) {anova_sql('away', 'source', 'away', False)}""")(
    lambda s, f: p6(i.levene(positive(s, f)))
)


def kruskal_sql(rows: str, group: str) -> str:
    return f"""SELECT k, n, {rnd('h', 4)} AS h_stat, {{p}} AS p_value, {rnd('(h - k + 1) / (n - k)', 4)} AS epsilon_sq FROM (
    SELECT k, n, (12 / (CAST(n AS DOUBLE) * (n + 1)) * s) / (1 - t / (CAST(n AS DOUBLE) ** 3 - n)) AS h FROM (
      SELECT count(*) AS k, CAST(sum(n) AS BIGINT) AS n, sum(t) AS t, sum(n * (r / n - (total + 1) / 2) ** 2) AS s FROM (
        SELECT {group}, count(*) AS n, sum(rk) AS r, sum(CAST(ties AS DOUBLE) ** 2 - 1) AS t, any_value(total) AS total FROM (
          SELECT {group}, rank() OVER (ORDER BY price) + (count(*) OVER (PARTITION BY price) - 1) / 2 AS rk,
            count(*) OVER (PARTITION BY price) AS ties, count(*) OVER () AS total FROM {rows}) GROUP BY {group})))"""


KRUSKAL = f"WITH {STG} " + kruskal_sql("pos", "source").replace("{p}", rnd(sql_chi2_p4("h"), 6))
register("kruskal", KRUSKAL)(lambda s, f: p6(i.kruskal(positive(s, f))))
register("kruskal_by_bucket", KRUSKAL)(
    lambda s, f: p6(i.kruskal(positive(s, f), few=0, per_bucket=500))
)
MWU = f"""WITH {STG}, ranked AS (
    SELECT g.a, g.b, pos.source, pos.price, rank() OVER (PARTITION BY g.a, g.b ORDER BY price)
      + (count(*) OVER (PARTITION BY g.a, g.b, price) - 1) / 2 AS rk, count(*) OVER (PARTITION BY g.a, g.b, price) AS ties
    FROM (SELECT x.source AS a, y.source AS b FROM (SELECT DISTINCT source FROM pos) x, (SELECT DISTINCT source FROM pos) y
      WHERE x.source < y.source) g JOIN pos ON pos.source IN (g.a, g.b)),
  u AS (SELECT a AS source_a, b AS source_b, CAST(count(*) FILTER (WHERE source = a) AS DOUBLE) AS n1,
    CAST(count(*) FILTER (WHERE source = b) AS DOUBLE) AS n2, sum(rk) FILTER (WHERE source = a) AS r1,
    sum(CAST(ties AS DOUBLE) ** 2 - 1) AS t, {pctl('price', 0.5, ' FILTER (WHERE source = a)')} AS med_a,
    {pctl('price', 0.5, ' FILTER (WHERE source = b)')} AS med_b FROM ranked GROUP BY a, b),
  z AS (SELECT *, r1 - n1 * (n1 + 1) / 2 AS u FROM u),
  p AS (SELECT *, {sql_norm_p("greatest(0, (greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - t / ((n1 + n2) * (n1 + n2 - 1)))))")} AS p FROM z)
  SELECT source_a, source_b, {rnd('med_a', 2)} AS median_a, {rnd('med_b', 2)} AS median_b, {rnd('u', 0)} AS u_stat, {rnd('p', 6)} AS p_value,
    {rnd('1 - 2 * u / (n1 * n2)', 3)} AS effect_r, CASE WHEN p < 0.05 THEN 'Yes' ELSE 'No' END AS significant FROM p"""
register("mann_whitney", MWU)(lambda s, f: i.mann_whitney(positive(s, f)))


@register(
    "mann_whitney_exact",
    f"""WITH RECURSIVE pos AS (SELECT n_name AS source, s_acctbal AS price FROM supplier JOIN nation ON s_nationkey = n_nationkey),
  g AS (SELECT source, count(*) AS n, {pctl('price', 0.5)} AS med FROM pos GROUP BY source),
  u AS (SELECT x.source AS source_a, y.source AS source_b, sum(CASE WHEN x.price > y.price THEN 1.0 WHEN x.price = y.price THEN 0.5 ELSE 0 END) AS u
    FROM pos x JOIN pos y ON x.source < y.source GROUP BY 1, 2),
  same AS (SELECT source_a, source_b, sum(t ** 3 - t) AS t FROM (SELECT source_a, source_b, price, count(*)::DOUBLE AS t
    FROM u JOIN pos ON pos.source IN (source_a, source_b) GROUP BY 1, 2, 3) GROUP BY 1, 2),
  -- Of i rows in order of value, m of the first group: in how many ways u comes about.
  ways AS (SELECT 0 AS i, 0 AS m, 0 AS u, 1.0::DOUBLE AS w
    UNION ALL SELECT i + 1, m + s.k, u + s.k * (i - m), sum(w) FROM ways, (VALUES (0), (1)) s(k) WHERE i < 40 AND m + s.k <= 20 GROUP BY 1, 2, 3),
  z AS (SELECT u.*, t, a.n AS n1, b.n AS n2, a.med AS med_a, b.med AS med_b FROM u JOIN same USING (source_a, source_b)
    JOIN g a ON a.source = source_a JOIN g b ON b.source = source_b),
  p AS (SELECT *, CASE WHEN least(n1, n2) <= 8 AND t = 0
      THEN least(1, 2 * (SELECT sum(w) FILTER (ways.u >= ceil(greatest(z.u, n1 * n2 - z.u))) / sum(w) FROM ways WHERE i = n1 + n2 AND m = n1))
      ELSE {sql_norm_p("greatest(0, (greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - t / ((n1 + n2) * (n1 + n2 - 1)))))")} END AS p FROM z)
  SELECT source_a, source_b, {rnd('med_a', 2)} AS median_a, {rnd('med_b', 2)} AS median_b, {rnd('u', 0)} AS u_stat, {rnd('p', 6)} AS p_value,
    {rnd('1 - 2 * u / (n1 * n2)', 3)} AS effect_r, CASE WHEN p < 0.05 THEN 'Yes' ELSE 'No' END AS significant FROM p""",
)
def mann_whitney_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Balances of suppliers by nation: small groups, so that the exact law holds for most pairs."""
    suppliers = tables.read_table(spark, sf, "supplier").join(tables.read_table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return i.mann_whitney(suppliers.select(F.col("n_name").alias("source"), F.col("s_acctbal").alias("price")))


register("mann_whitney_by_bucket", MWU)(
    lambda s, f: i.mann_whitney(positive(s, f), few=0, per_bucket=500)
)
register("p_value_matrix", f"""WITH m AS ({MWU}), x AS (SELECT source_a AS "row", source_b AS col, p_value FROM m
    UNION ALL SELECT source_b, source_a, p_value FROM m UNION ALL SELECT DISTINCT s, s, 1.0 FROM (
      SELECT source_a AS s FROM m UNION SELECT source_b FROM m))
  SELECT "row", col, p_value, {rnd('log10(p_value + 1e-10)', 4)} AS log10_p FROM x""")(
    lambda s, f: i.p_value_matrix(i.mann_whitney(positive(s, f)))
)
TOP4 = STG + """, top AS (SELECT category FROM pos WHERE category IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, category LIMIT 5),
  cat AS (SELECT * FROM pos WHERE category IN (SELECT category FROM top))"""
register("category_anova", f"WITH {TOP4} {anova_sql('cat', 'category', 'price')}")(
    lambda s, f: p6(i.category_anova(positive(s, f), 5))
)
register("category_kruskal", f"WITH {TOP4} " + kruskal_sql("cat", "category").replace("{p}", rnd(sql_chi2_p4("h"), 6)))(
    lambda s, f: p6(i.category_kruskal(positive(s, f), 5))
)
register("category_means", f"WITH {TOP4} SELECT category, count(*) AS n, {MEAN2}, {MEDIAN2} FROM cat GROUP BY category HAVING count(*) >= 5")(
    lambda s, f: i.category_means(positive(s, f), 5)
)
# Quantile of Student's t near the normal one, by the usual expansion in 1 / df.
Z975 = "1.959963984540054"
TQ = (f"({Z975} + ({Z975}**3 + {Z975}) / (4 * df) + (5 * {Z975}**5 + 16 * {Z975}**3 + 3 * {Z975}) / (96 * df**2)"
      f" + (3 * {Z975}**7 + 19 * {Z975}**5 + 17 * {Z975}**3 - 15 * {Z975}) / (384 * df**3))")
register("confidence_interval", f"""WITH {MOM}, ci AS (SELECT source, n, mean, sqrt(var / n) AS se, CAST(n - 1 AS DOUBLE) AS df FROM mom)
  SELECT source, n, {rnd('mean', 2)} AS mean, {rnd('se', 3)} AS se, {rnd(f'mean - {TQ} * se', 2)} AS ci_lower,
    {rnd(f'mean + {TQ} * se', 2)} AS ci_upper, {rnd(f'2 * {TQ} * se', 2)} AS ci_width FROM ci""")(
    lambda s, f: i.confidence_interval(positive(s, f))
)


def regress_sql(rows: str, y: str, x: str, group: str | None) -> str:
    by, g = (f"{group}, ", f"GROUP BY {group}") if group else ("", "")
    return f"""fit AS (SELECT {by}count(*) AS n, regr_slope({y}, {x}) AS b, regr_intercept({y}, {x}) AS a, corr({y}, {x}) AS r,
    regr_sxx({y}, {x}) AS sxx, regr_syy({y}, {x}) AS syy FROM {rows} {g}),
  sc AS (SELECT *, {sql_t_p('r * sqrt(n - 2) / sqrt(1 - r * r)', '(n - 2)')} AS p, sqrt((1 - r * r) * syy / (sxx * (n - 2))) AS se FROM fit)"""


FIT = f"""n, {rnd('b', 4)} AS slope, {rnd('a', 2)} AS intercept, {rnd('r', 4)} AS r, {rnd('r * r', 4)} AS r2, {rnd('p', 6)} AS p_value,
  {rnd('se', 4)} AS se, CASE WHEN p < 0.05 THEN 'Yes' ELSE 'No' END AS significant FROM sc"""
register("rating_regression", f"WITH {STG}, {regress_sql('pos', 'price', 'rating', 'source')} SELECT source, {FIT}")(
    lambda s, f: i.linregress(positive(s, f), "price", "rating", "source")
)
register("rating_regression_pooled", f"WITH {STG}, {regress_sql('pos', 'price', 'rating', None)} SELECT {FIT}")(
    lambda s, f: i.linregress(positive(s, f), "price", "rating", None, 5)
)
register("lineitem_regression", f"WITH {LINES}, {regress_sql('lines', 'price', 'rating', 'source')} SELECT source, {FIT}")(
    lambda s, f: i.linregress(lines(s, f), "price", "rating", "source")
)
DAYS = STG + """, dated AS (SELECT *, (epoch_us(scraped_at) - (SELECT min(epoch_us(scraped_at)) FROM pos)) / 86400000000.0 AS days,
  ln(price) AS lp FROM pos)"""
register("trend", f"""WITH {DAYS}, {regress_sql('dated', 'price', 'days', 'source')}
  SELECT source, {rnd('b', 4)} AS slope_per_day, {rnd('r * r', 4)} AS r2, {rnd('p', 6)} AS p_value,
  CASE WHEN {rnd('b', 4)} > 0 THEN 'Rising' ELSE 'Falling' END AS trend FROM sc""")(lambda s, f: i.trend(positive(s, f)))
register("log_price_model", f"""WITH {DAYS}, c AS (SELECT count(*) AS n, avg(rating) AS m1, avg(days) AS m2, avg(lp) AS my,
    covar_samp(rating, rating) AS c11, covar_samp(rating, days) AS c12, covar_samp(days, days) AS c22,
    covar_samp(rating, lp) AS c1y, covar_samp(days, lp) AS c2y, covar_samp(lp, lp) AS cyy FROM dated WHERE rating IS NOT NULL),
  b AS (SELECT *, c11 * c22 - c12 * c12 AS det, (c22 * c1y - c12 * c2y) / (c11 * c22 - c12 * c12) AS b1,
    (c11 * c2y - c12 * c1y) / (c11 * c22 - c12 * c12) AS b2, n - 3 AS df FROM c),
  s AS (SELECT *, b1 * c1y + b2 * c2y AS expl, (n - 1) * (cyy - b1 * c1y - b2 * c2y) / df AS res FROM b),
  terms AS (
    SELECT 'Intercept' AS term, my - b1 * m1 - b2 * m2 AS coef,
      sqrt(res / n + res / (n - 1) * (m1 * m1 * c22 - 2 * m1 * m2 * c12 + m2 * m2 * c11) / det) AS se, expl / cyy AS r2, df, n FROM s
    UNION ALL SELECT 'rating', b1, sqrt(res / (n - 1) * c22 / det), expl / cyy, df, n FROM s
    UNION ALL SELECT 'days_since_start', b2, sqrt(res / (n - 1) * c11 / det), expl / cyy, df, n FROM s)
  SELECT term, {rnd('coef', 6)} AS coef, {rnd('se', 6)} AS se, {rnd('coef / se', 3)} AS t, {rnd(sql_t_p('coef / se', 'df'), 6)} AS p_value,
    {rnd('r2', 6)} AS r2, {rnd('1 - (1 - r2) * (n - 1) / df', 6)} AS r2_adj, n FROM terms""")(
    lambda s, f: i.log_price_model(positive(s, f))
)
register("power_adequacy", f"""WITH {STG} SELECT source, count(*) AS n, 63 AS required_n,
  CASE WHEN count(*) >= 63 THEN 'OK' ELSE 'UNDERPOWERED' END AS adequacy FROM pos GROUP BY source""")(
    lambda s, f: i.power_adequacy(positive(s, f))
)
register("cohens_d", f"""WITH {MOM}, x AS (SELECT source_a, source_b, (mean_a - mean_b) / sqrt((var_a + var_b) / 2) AS d FROM pr)
  SELECT source_a, source_b, {rnd('d', 3)} AS cohen_d, CASE WHEN abs(d) >= 0.8 THEN 'large' WHEN abs(d) >= 0.5 THEN 'medium'
  ELSE 'small' END AS magnitude FROM x""")(lambda s, f: i.cohens_d(positive(s, f)))
# Shapiro-Wilk needs normal order statistics of a sorted sample; SQL has no counterpart.
register("shapiro")(lambda s, f: i.shapiro(positive(s, f), key=["event_id"]))



# Rows of each report table; the values of each have a query of their own.
BY_SOURCE = "dispersion shape volatility outliers median_pivot normality confidence rating_regression time_regression power"
ONE_ROW = "levene anova kruskal category_anova category_kruskal"
PAIRED = "welch mann_whitney effects"
REPORT_ROWS = {
    "central": "s.n + 1",
    **dict.fromkeys(BY_SOURCE.split(), "s.n"),
    **dict.fromkeys(PAIRED.split(), "s.n * (s.n - 1) // 2"),
    **dict.fromkeys(ONE_ROW.split(), "1"),
    "category_summary": "(SELECT count(DISTINCT category) FROM pos)",
    "category_means": "(SELECT least(8, count(*)) FROM (SELECT category FROM pos WHERE category IS NOT NULL GROUP BY 1 HAVING count(*) >= 5))",
    "daily_average": "(SELECT count(*) FROM (SELECT DISTINCT scraped_date, source FROM pos))",
    "daily_volume": "(SELECT count(DISTINCT scraped_date) FROM pos)",
    "full_summary": "(SELECT count(*) FROM (SELECT DISTINCT source, category FROM pos WHERE category IS NOT NULL))",
    "log_price_model": "3",
}


@register(
    "stat_tables",
    f"WITH {STG}, s AS (SELECT count(DISTINCT source) AS n FROM pos) "
    + " UNION ALL ".join(f"SELECT '{x}' AS name, {n}::BIGINT AS row_count, DATE '2024-01-30' AS run_date FROM s" for x, n in REPORT_ROWS.items()),
)
def stat_tables(spark: SparkSession, sf: str) -> DataFrame:
    """All result tables of both reports, written with the date of the run and read back."""
    rows, base = stash(positive(spark, sf), "rows"), fresh_dir(spark, "stats")
    built = {**reports.descriptive_report(rows, tables.EVENT_TIE), **reports.inferential_report(rows)}
    files.write_stat_tables(built, base, "2024-01-30")
    parts = [
        files.read_mart(spark, f"{base}/{name}").groupBy("run_date").agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("name"), "row_count", "run_date"
        )
        for name in built
    ]
    return reduce(DataFrame.unionByName, parts)


#: Report table -> the query that has its values row by row, and the columns that are summed here.
REPORT_VALUES = {
    "central": ("central_tendency", "n mean median mode geometric_mean"),
    "dispersion": ("dispersion", "std variance q25 q75 iqr range_ cv_pct"),
    "shape": ("shape", "n skewness kurtosis"),
    "category_summary": ("category_summary", "n mean median std q25 q75"),
    "daily_volume": ("daily_volume", "records"),
    "volatility": ("change_volatility", "mean_chg std_chg pct_drops pct_spikes"),
    "outliers": ("outlier_summary", "n iqr_outliers z_outliers lower_fence upper_fence"),
    "full_summary": ("full_summary", "count mean median std min max q25 q75 skewness"),
    "levene": ("levene", "f_stat"),
    "welch": ("welch_t", "mean_a mean_b mean_diff t_stat p_value"),
    "mann_whitney": ("mann_whitney", "median_a median_b u_stat p_value effect_r"),
    "anova": ("anova", "f_stat eta_sq"),
    "kruskal": ("kruskal", "h_stat epsilon_sq"),
    "confidence": ("confidence_interval", "n mean se ci_lower ci_upper"),
    "rating_regression": ("rating_regression", "slope intercept r2"),
    "time_regression": ("trend", "slope_per_day r2"),
    "log_price_model": ("log_price_model", "coef se n"),
    "power": ("power_adequacy", "n required_n"),
    "effects": ("cohens_d", "cohen_d"),
}


@register(
    "stat_table_values",
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, '{x}' AS metric, {rnd(f'sum({chr(34)}{x}{chr(34)})::DOUBLE', 3)} AS value FROM ({ORACLES[query]})"
        for name, (query, columns) in REPORT_VALUES.items()
        for x in columns.split()
    ),
)
def stat_table_values(spark: SparkSession, sf: str) -> DataFrame:
    """The sum of every number in the report tables, as they were written and read back."""
    rows, base = stash(positive(spark, sf), "rows"), fresh_dir(spark, "stats")
    built = {**reports.descriptive_report(rows, tables.EVENT_TIE), **reports.inferential_report(rows)}
    files.write_stat_tables({name: built[name] for name in REPORT_VALUES}, base, "2024-01-30")
    parts = []
    for name, (_, columns) in REPORT_VALUES.items():
        sums = [F.struct(F.lit(x).alias("metric"), F.round(F.sum(x).cast("double"), 3).alias("value")) for x in columns.split()]
        table = files.read_mart(spark, f"{base}/{name}").agg(F.array(*sums).alias("m"))
        parts.append(table.select(F.lit(name).alias("name"), F.inline("m")))
    return reduce(DataFrame.unionByName, parts)


# --------------------------------------------------------------------------- data quality

NOW = "2024-01-25 00:00:00"


def checks(spark: SparkSession, sf: str) -> DataFrame:
    rows = staged(spark, sf).withColumn("source", c.normalize_source("source"))
    return q.run_checks(rows, as_of=NOW)


EXISTS = " UNION ALL ".join(f"SELECT 'column ''{x}'' exists' AS \"check\", true AS passed, '' AS detail" for x in q.REQUIRED_COLUMNS)
CHECKS = f"""WITH {STG}, l AS (SELECT {pctl('price', 0.25)} AS q1, {pctl('price', 0.75)} AS q3 FROM stg),
  a AS (SELECT count(*) AS n, avg((price < q1 - 3 * (q3 - q1) OR price > q3 + 3 * (q3 - q1))::INT) * 100 AS far, min(price) AS lo,
    max(price) AS hi, count(*) FILTER (WHERE price <= 0) AS np, (count(*) - count(DISTINCT product_id)) / count(*) * 100 AS dup,
    count(*) FILTER (WHERE scraped_at > TIMESTAMP '{NOW}') AS fut FROM stg, l),
  src AS (SELECT source, count(*) AS c FROM stg GROUP BY 1)
  {EXISTS}
  UNION ALL SELECT '''' || x || ''' null rate < 1%', true, '0.0% nulls' FROM (VALUES ('product_id'), ('price'), ('source')) v(x)
  UNION ALL SELECT 'price column is numeric', true, '0 non-numeric'
  UNION ALL SELECT 'all prices > 0', np = 0, np || ' zero/negative' FROM a
  UNION ALL SELECT 'price max < 1_000_000', hi < 1000000, format('max={{:.2f}}', hi) FROM a
  UNION ALL SELECT 'price min >= 0.01', lo >= 0.01, format('min={{:.4f}}', lo) FROM a
  UNION ALL SELECT 'extreme price outliers < 5%', far < 5, format('{{:.1f}}% extreme outliers', far) FROM a
  UNION ALL SELECT 'all sources are known', true, ''
  UNION ALL SELECT 'each source has >= 5 records', (SELECT min(c) FROM src) >= 5, 'low-count sources: {{}}'
  UNION ALL SELECT 'product_id duplicate rate < 80%', dup < 80, format('{{:.1f}}% duplicates (expected for time-series)', dup) FROM a
  UNION ALL SELECT 'product_id not all null', true, ''
  UNION ALL SELECT 'scraped_at null rate < 5%', true, '0.0% nulls'
  UNION ALL SELECT 'no future scraped_at values', fut = 0, fut || ' future rows' FROM a
  UNION ALL SELECT 'scraped_at >= 2020-01-01', true, '0.0% pre-2020'
  UNION ALL SELECT 'title empty rate < 5%', true, '0.0% empty'
  UNION ALL SELECT 'currency null rate < 10%', true, '0.0% nulls'
  UNION ALL SELECT 'rating in [0, 5]', true, 'out-of-range: 0'"""
register("run_checks", CHECKS)(checks)
register("quality_score", f"""WITH c AS ({CHECKS}) SELECT count(*) AS checks, count(*) FILTER (WHERE passed) AS passed,
  count(*) FILTER (WHERE NOT passed) AS failed, {rnd('count(*) FILTER (WHERE passed) / count(*) * 100', 1)} AS score_pct FROM c""")(
    lambda s, f: q.quality_score(checks(s, f))
)
register("unknown_sources", f"WITH {STG} SELECT DISTINCT source FROM stg WHERE source NOT IN ('jumia.ma', 'ultrapc.ma')")(
    lambda s, f: q.unknown_sources(staged(s, f), ["jumia.ma", "ultrapc.ma"])
)
register("expect_not_null", f"WITH {STG} SELECT event_id, category, image_url FROM stg WHERE category IS NULL OR image_url IS NULL")(
    lambda s, f: q.expect_not_null(staged(s, f), ["category", "image_url"]).select("event_id", "category", "image_url")
)
register("expect_unique", f"WITH {STG} SELECT product_id, count(*) AS n FROM stg GROUP BY 1 HAVING count(*) > 1")(
    lambda s, f: q.expect_unique(staged(s, f), "product_id")
)
register("expect_in", f"WITH {STG} SELECT event_id, source FROM stg WHERE source NOT IN ({', '.join(repr(x) for x in KNOWN_HOSTS[:3])})")(
    lambda s, f: q.expect_in(staged(s, f), "source", KNOWN_HOSTS[:3]).select("event_id", "source")
)
register("expect_non_negative", f"WITH {RAW}, {BROKEN} SELECT event_id, price FROM broken WHERE price < 0")(
    lambda s, f: q.expect_non_negative(broken(s, f), "price").select("event_id", "price")
)
register("expect_not_future", f"WITH {STG} SELECT event_id, scraped_at FROM stg WHERE scraped_at > TIMESTAMP '{NOW}' + INTERVAL 5 MINUTE")(
    lambda s, f: q.expect_not_future(staged(s, f), as_of=NOW).select("event_id", "scraped_at")
)
register("expect_change_bounded", f"""WITH {CHG} SELECT product_id, scraped_at, price_change_pct FROM chg
  WHERE prev_price IS NOT NULL AND (price_change_pct > 500 OR price_change_pct < -100)""")(
    lambda s, f: q.expect_change_bounded(m.price_history(changes(s, f))).select("product_id", "scraped_at", "price_change_pct")
)


@register("mart_expectations", f"""WITH {CHG} SELECT e AS expectation, CASE e WHEN 'history change bounded' THEN (SELECT count(*) FROM chg
    WHERE prev_price IS NOT NULL AND (price_change_pct > 500 OR price_change_pct < -100))
    WHEN 'staged not in future' THEN (SELECT count(*) FROM stg WHERE scraped_at > TIMESTAMP '{NOW}' + INTERVAL 5 MINUTE)
    ELSE 0 END AS failures FROM (SELECT unnest([{', '.join(f"'{x}'" for x in [
        *[f"staged {y} not null" for y in ("product_id", "source", "url", "title", "price", "currency", "scraped_at", "scraped_date")],
        "staged source accepted", "staged currency accepted", "staged price non negative", "staged not in future",
        "current product_id unique", "current not null", "current price non negative", "history not null",
        "history price non negative", "history change bounded", "stats not null", "stats average non negative", "alerts not null",
    ])}]) AS e)""")
def mart_expectations(spark: SparkSession, sf: str) -> DataFrame:
    rows = stash(staged(spark, sf), "staged")
    built = m.build_marts(stash(h.dedupe_daily(rows, tables.EVENT_TIE), "deduped"), last_day(spark, sf))
    return q.mart_failures(rows, {name: stash(df, name) for name, df in built.items()}, NOW)


@register("dq_report", f"""WITH c AS ({CHECKS}) SELECT (SELECT count(*) FROM events) AS rows, count(*) FILTER (WHERE passed) AS passed,
  count(*) FILTER (WHERE NOT passed) AS failed, {rnd('count(*) FILTER (WHERE passed) / count(*) * 100', 1)} AS score_pct,
  count(*) AS checks FROM c""")
def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = staged(spark, sf)
    path = fresh_dir(spark, "dq")
    files.write_dq_report(files.dq_report(checks(spark, sf), rows.count(), rows.columns), path)
    return spark.read.json(path).select("rows", "passed", "failed", "score_pct", F.size("checks").cast("long").alias("checks"))


@register("non_empty_gate", f"WITH {STG} SELECT count(*) AS rows, true AS empty_refused FROM stg")
def non_empty_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Rows pass the gate, none do not."""
    rows = staged(spark, sf)
    try:
        files.assert_non_empty(rows.where(F.col("price") < 0))
        refused = False
    except ValueError:
        refused = True
    return files.assert_non_empty(rows).agg(F.count(F.lit(1)).alias("rows")).withColumn("empty_refused", F.lit(refused))


@register("quality_gate", f"""WITH c AS ({CHECKS}) SELECT string_agg("check", '; ' ORDER BY "check") AS failed, bool_and(passed) AS goes_on FROM c WHERE NOT passed""")
def quality_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The gate names the checks that failed, and lets the others go on."""
    found = stash(checks(spark, sf), "checks")
    try:
        q.fail_on_error(found)
        failed = None
    except q.QualityError as err:
        failed = "; ".join(sorted(str(err).split("; ")))
    passing = q.fail_on_error(found.where("passed")).agg(F.count(F.lit(1)).alias("n"))
    return passing.select(F.lit(failed).cast("string").alias("failed"), F.lit(None if failed is None else False).cast("boolean").alias("goes_on"))


# --------------------------------------------------------------------------- streaming

def texts(spark: SparkSession, sf: str, base: str) -> DataFrame:
    """The records as a stream of several micro-batches, in no order of time."""
    tables.json_files(spark, sf, f"{base}/sent")
    return ingest.text_stream(spark, f"{base}/sent", max_files=1)


run = ingest.wait


@register("stream_ingest", f"""WITH {JSON_OK} SELECT product_id, source, title, price, currency, rating, coalesce(raw_av, 'Unknown') AS availability,
  scraped_at, 'nifi-streaming' AS pipeline FROM (SELECT DISTINCT * FROM good)""")
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Accepted records of all batches, replays dropped; a sink that was down gets its batches afterwards.

    The time of a record that was sent without one is the time of ingest: shown as null.
    """
    base = fresh_dir(spark, "ingest")

    def broken_sink(batch: DataFrame, batch_id: int) -> None:
        raise OSError("sink is down")

    sinks = [ingest.Sink("late", broken_sink), ingest.folder_sink("off", f"{base}/off", enabled=False), ingest.folder_sink("valid", f"{base}/valid")]
    run(*ingest.ingest_stream(texts(spark, sf, base), sinks, ingest.folder_sink("rejects", f"{base}/rejects"), f"{base}/cp"))
    ingest.retry_failed(spark, ingest.folder_sink("late", f"{base}/late"), f"{base}/cp/valid/failed")
    return spark.read.parquet(f"{base}/late").select(
        "product_id", "source", "title", "price", "currency", "rating", "availability",
        F.when(F.col("scraped_at") < "2025-01-01", F.col("scraped_at")).alias("scraped_at"), "pipeline",
    )


@register("stream_rejects", f"""WITH {STG}, {SENT} SELECT reject_reason, count(*) AS n FROM (
    SELECT CASE WHEN corrupt THEN 'corrupt record' WHEN title2 = '' THEN 'missing title' WHEN price2 < 0 THEN 'negative price' END AS reject_reason
    FROM sent) WHERE reject_reason IS NOT NULL GROUP BY 1""")
def stream_rejects(spark: SparkSession, sf: str) -> DataFrame:
    base = fresh_dir(spark, "rejects")
    sink = ingest.folder_sink("rejects", f"{base}/rejects")
    run(ingest.start(ingest.rejected_records(ingest.prepare(texts(spark, sf, base))), [sink], f"{base}/cp"))
    return spark.read.parquet(f"{base}/rejects").groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@register("stream_counters", f"""WITH {JSON_OK} SELECT (SELECT count(*) FROM sent) AS sent, (SELECT count(*) FROM (SELECT DISTINCT * FROM good)) AS ingested,
  (SELECT count(*) FROM good) - (SELECT count(*) FROM (SELECT DISTINCT * FROM good)) AS replays,
  (SELECT count(*) FROM sent WHERE corrupt OR title2 = '' OR price2 < 0) AS errors""")
def stream_counters(spark: SparkSession, sf: str) -> DataFrame:
    """What became of every record that was sent: written, a replay, or refused."""
    base = fresh_dir(spark, "counters")
    sinks = [ingest.folder_sink("valid", f"{base}/valid")]
    run(*ingest.ingest_stream(texts(spark, sf, base), sinks, ingest.folder_sink("rejects", f"{base}/rejects"), f"{base}/cp"))
    refused = spark.read.parquet(f"{base}/rejects").agg(F.count(F.lit(1)).alias("errors"))
    written = spark.read.parquet(f"{base}/valid").agg(F.count(F.lit(1)).alias("ingested"))
    sent = spark.read.text(f"{base}/sent").agg(F.count(F.lit(1)).alias("sent"))
    counted = ingest.read_counters(spark, f"{base}/cp/valid").select("replays")
    return sent.join(written).join(counted).join(refused)


@register("stream_to_jsonl", f"WITH {STG} SELECT product_id, price, scraped_at FROM stg")
def stream_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    base = fresh_dir(spark, "sjsonl")
    stream = st.stage_prices(tables.raw_from_events(tables.stream_table(spark, sf, "events"))).select(*PRICE_COLUMNS)
    run(ingest.stream_to_jsonl(stream, f"{base}/out", f"{base}/cp"))
    return spark.read.schema(PRICE_SCHEMA).json(f"{base}/out").select("product_id", "price", "scraped_at")


RATES = f"""SELECT time_bucket(INTERVAL 5 MINUTE, scraped_at) AS window_start, count(*) AS events, count(*) / 300 AS events_per_sec,
  count(*) FILTER (WHERE source = 'scrapeme.live') / count(*) AS error_ratio, (list_sort(list(price)))[CAST(ceil(0.5 * count(*)) AS BIGINT)] AS p50,
  (list_sort(list(price)))[CAST(ceil(0.95 * count(*)) AS BIGINT)] AS p95 FROM stg GROUP BY 1"""
register("event_rates", f"WITH {STG} {RATES}")(
    lambda s, f: live.event_rates(staged(s, f), is_error=F.col("source") == "scrapeme.live")
)


@register("stream_event_rates", f"WITH {STG} {RATES}")
def stream_rates(spark: SparkSession, sf: str) -> DataFrame:
    base = fresh_dir(spark, "rates")
    stream = st.stage_prices(tables.raw_from_events(tables.stream_table(spark, sf, "events")))
    rates = live.event_rates(stream, is_error=F.col("source") == "scrapeme.live")
    run(live.start_rates(rates, f"{base}/out", f"{base}/cp"))
    return live.read_rates(spark, f"{base}/out")


register("event_rates_sketch", f"""WITH {STG} SELECT time_bucket(INTERVAL 5 MINUTE, scraped_at) AS window_start, count(*) AS events, count(*) / 300 AS events_per_sec,
  count(*) FILTER (WHERE source = 'scrapeme.live') / count(*) AS error_ratio, true AS p50_near, true AS p95_near FROM stg GROUP BY 1""")(
    lambda s, f: near_ranks(s, f, live.event_rates(staged(s, f), is_error=F.col("source") == "scrapeme.live", approx=True))
)


def near_ranks(spark: SparkSession, sf: str, rates: DataFrame) -> DataFrame:
    """Whether the sketched quantiles are within the stated error of their rank, by counting the window's prices below."""
    prices = staged(spark, sf).select(F.window("scraped_at", "300 seconds").start.alias("window_start"), "price")
    both = prices.join(rates, "window_start").groupBy("window_start", "events", "events_per_sec", "error_ratio")
    share = {"p50": 0.5, "p95": 0.95}
    counted = both.agg(
        *[F.count_if(F.col("price") < F.col(q)).alias(f"{q}_below") for q in share], *[F.count_if(F.col("price") <= F.col(q)).alias(f"{q}_upto") for q in share]
    )
    # A rank is a whole number, so one event is always allowed.
    slack = F.lit(live.SKETCH_RANK_ERROR) * F.col("events") + 1
    near = [
        ((F.col(f"{q}_below") <= F.lit(x) * F.col("events") + slack) & (F.col(f"{q}_upto") >= F.lit(x) * F.col("events") - slack)).alias(f"{q}_near")
        for q, x in share.items()
    ]
    return counted.select("window_start", "events", "events_per_sec", "error_ratio", *near)


@register("stream_sketched_rates", f"WITH {STG} SELECT count(*) AS events, count(DISTINCT time_bucket(INTERVAL 5 MINUTE, scraped_at)) AS windows FROM stg")
def stream_sketched(spark: SparkSession, sf: str) -> DataFrame:
    base = fresh_dir(spark, "sketch")
    stream = st.stage_prices(tables.raw_from_events(tables.stream_table(spark, sf, "events")))
    run(live.start_rates(live.event_rates(stream, approx=True), f"{base}/out", f"{base}/cp"))
    rates = live.read_rates(spark, f"{base}/out").where(F.col("p50") <= F.col("p95"))
    return rates.agg(F.sum("events").alias("events"), F.count(F.lit(1)).alias("windows"))


@register("stream_limited", f"WITH {STG}, {SENT} SELECT least(count(*), 1000) AS delivered, least(count(*), 1000) AS known FROM sent")
def stream_limited(spark: SparkSession, sf: str) -> DataFrame:
    """Exactly the wanted number of records over several batches, each of them one that was sent."""
    base = fresh_dir(spark, "limited")
    stream = texts(spark, sf, base)
    run(ingest.start_limited(stream, ingest.folder_sink("some", f"{base}/some"), f"{base}/cp", 1000))
    some = spark.read.parquet(f"{base}/some").drop("batch")
    known = some.intersectAll(spark.read.text(f"{base}/sent"))
    return some.agg(F.count(F.lit(1)).alias("delivered")).join(known.agg(F.count(F.lit(1)).alias("known")))


CURRENT_RAW = f"""WITH {STG} SELECT product_id, source, price, scraped_at FROM (SELECT *, row_number() OVER (PARTITION BY product_id
  ORDER BY scraped_at DESC, event_id DESC) AS rn FROM stg) WHERE rn = 1"""


@register("stream_current_prices", CURRENT_RAW)
def stream_current(spark: SparkSession, sf: str) -> DataFrame:
    base = fresh_dir(spark, "current")
    stream = st.stage_prices(tables.raw_from_events(tables.stream_table(spark, sf, "events")))
    run(live.start_current(stream, f"{base}/log", f"{base}/cp", tables.EVENT_TIE))
    live.compact_current(spark, f"{base}/log", f"{base}/compact", tables.EVENT_TIE)
    return live.read_current(spark, f"{base}/compact", tables.EVENT_TIE).select("product_id", "source", "price", "scraped_at")


@register("stream_wide_rows", f"WITH {WIDE} SELECT row_key, price, rating FROM wide")
def stream_wide(spark: SparkSession, sf: str) -> DataFrame:
    base = fresh_dir(spark, "swide")
    stream = st.stage_prices(tables.raw_from_events(tables.stream_table(spark, sf, "events")))
    sink = ingest.Sink("wide", lambda batch, _: widerow.upsert_wide_row(batch, f"{base}/wide", buckets=BUCKETS))
    run(ingest.start(stream, [sink], f"{base}/cp"))
    widerow.compact(widerow.read_rows(spark, f"{base}/wide"), f"{base}/compact")
    return widerow.decode_wide_row(widerow.read_rows(spark, f"{base}/compact")).select("row_key", "price", "rating")
