import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history as h
from tidemark.operators import staging as st
from tidemark.plans import marts as m

FIELDS = (
    "product_id string, source string, url string, title string, price double, currency string, rating double, "
    "availability string, category string, image_url string, scraped_at timestamp"
)


def at(day, hour):
    return dt.datetime(2024, 1, day, hour, tzinfo=dt.timezone.utc)


def observation(product, when, price, source="jumia.ma"):
    return (product, source, f"https://x/{product}", f" {product} ", price, " mad", None, "", " ", "", when)


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(
        [
            observation("p1", at(1, 8), 100.0), observation("p1", at(1, 20), 110.0), observation("p1", at(2, 9), 99.0),
            observation("p1", at(5, 9), 99.0), observation("p2", at(1, 9), 0.0), observation("p2", at(2, 9), 5.0),
            observation("p3", at(1, 9), 10000.0), observation("p3", at(2, 9), 9500.4),
            observation("p4", at(2, 9), -1.0), observation(None, at(2, 9), 1.0),
        ],
        FIELDS,
    )


def test_staging(raw):
    row = st.stage_prices(raw).where("product_id = 'p1'").first()
    assert (row.title, row.currency, row.availability, row.category, row.image_url) == ("p1", "MAD", "Unknown", None, None)
    assert row.scraped_date == dt.date(2024, 1, 1)
    assert st.stage_prices(raw).count() == 8
    assert st.stage_prices(raw, min_price=5).where("price < 5").isEmpty()


def test_staging_of_text_columns(spark):
    text = spark.createDataFrame(
        [("a", "s", "u", "t", "12.5", "mad", "x", None, None, None, "2024-01-01T00:00:00Z"), ("b", "s", "u", "t", "bad", "mad", "4", None, None, None, "no")],
        FIELDS.replace("double", "string").replace("timestamp", "string"),
    )
    rows = st.stage_prices(text).collect()
    assert [(r.product_id, r.price, r.rating) for r in rows] == [("a", 12.5, None)]


def test_mini_history(raw):
    changes = h.price_changes(h.dedupe_daily(st.stage_prices(raw)))
    got = {(r.product_id, r.scraped_at.day): r for r in changes.collect()}
    assert len(got) == 7
    assert got["p1", 1].price == 110.0 and got["p1", 1].prev_price is None
    assert got["p1", 2].price_change_pct == -10.0 and got["p1", 2].price_change_abs == -11.0
    assert got["p1", 5].price_change_pct == 0.0 and got["p1", 5].prev_date == dt.date(2024, 1, 2)
    assert got["p2", 2].price_change_pct is None and got["p2", 2].price_change_abs == 5.0
    assert got["p3", 2].price_change_pct == -5.0


def test_alerts_and_current(raw):
    deduped = h.dedupe_daily(st.stage_prices(raw))
    alerts = m.price_alerts(h.price_changes(deduped), "2024-01-05")
    assert {(r.product_id, r.price_change_pct) for r in alerts.collect()} == {("p1", -10.0), ("p3", -5.0)}
    assert m.price_alerts(h.price_changes(deduped), "2024-01-20").isEmpty()
    current = m.current_prices(deduped)
    assert {(r.product_id, r.price) for r in current.collect()} == {("p1", 99.0), ("p2", 5.0), ("p3", 9500.4)}
    assert current.exceptAll(m.current_prices_by_join(deduped)).isEmpty()
    assert current.join(deduped, ["product_id", "scraped_at"], "left_anti").isEmpty()
    assert h.dedupe_daily(deduped).exceptAll(deduped).isEmpty()


def test_stats(raw):
    deduped = h.dedupe_daily(st.stage_prices(raw))
    row = m.price_stats(deduped).first()
    assert (row.product_count, row.observation_count, row.min_price, row.max_price) == (3, 7, 0.0, 10000.0)
    assert row.median_price == 99.0
    assert m.price_stats(deduped, approx=True).first().median_price == 99.0


def test_ties_have_one_winner(spark):
    rows = [observation("p", at(1, 1), float(i)) for i in range(50)]
    random.Random(1).shuffle(rows)
    staged = st.stage_prices(spark.createDataFrame(rows, FIELDS).repartition(7))
    assert h.dedupe_daily(staged).first().price == 49.0


def test_lag_with_a_hot_product(spark):
    rng = random.Random(3)
    data = [(f"p{0 if rng.random() < 0.6 else rng.randrange(1, 9)}", rng.randrange(10_000), i, rng.random()) for i in range(2000)]
    df = spark.createDataFrame(data, "product_id string, s long, event_id long, price double").withColumn(
        "scraped_at", F.timestamp_seconds("s")
    )
    order = ["scraped_at", "event_id"]
    plain = {(r.event_id, r.prev_price) for r in h.lag_price(df, order).collect()}
    for partitions in (1, 13, 200):
        assert {(r.event_id, r.prev_price) for r in h.lag_price(df, order, partitions).collect()} == plain
    last, want = {}, set()
    for p, s, e, price in sorted(data, key=lambda x: (x[1], x[2])):
        want.add((e, last.get(p)))
        last[p] = price
    assert plain == want


def test_lag_over_copies(spark):
    df = spark.createDataFrame([("p", 1, 5.0)] * 4 + [("p", 2, 7.0)] * 2, "product_id string, s long, price double")
    df = df.withColumn("scraped_at", F.timestamp_seconds("s"))
    for partitions in (1, 3, 6):
        got = sorted(((r.s, r.prev_price) for r in h.lag_price(df, ["scraped_at"], partitions).collect()), key=str)
        assert got == sorted([(1, None)] + [(1, 5.0)] * 3 + [(2, 5.0), (2, 7.0)], key=str)


def test_lag_splits_a_hot_moment(spark):
    """All rows of one product at one time are dealt to several partitions, and nulls are a product."""
    rows = [("hot", 1, 5.0)] * 3000 + [("hot", 2, 6.0), (None, 1, 1.0), (None, 2, None), (None, 3, 3.0), ("z", 1, 9.0)]
    df = spark.createDataFrame(rows, "product_id string, s long, price double").withColumn("scraped_at", F.timestamp_seconds("s"))
    dealt = h.lag_price(df, ["scraped_at"], 8)
    got = sorted(((r.product_id, r.s, r.prev_price) for r in dealt.collect()), key=str)
    want = [("hot", 1, None)] + [("hot", 1, 5.0)] * 2999 + [("hot", 2, 5.0), (None, 1, None), (None, 2, 1.0), (None, 3, None), ("z", 1, None)]
    assert got == sorted(want, key=str)
    folder = spark.read.parquet(dealt.inputFiles()[0].rsplit("/", 1)[0])
    assert folder.where("product_id = 'hot'").groupBy("_part").count().count() >= 6
    assert h.lag_price(df.limit(0), ["scraped_at"], 4).collect() == []


def test_last_non_null(spark):
    df = spark.createDataFrame([("a", 1, 5, None), ("a", 2, None, "x"), ("a", 3, None, None)], "k string, t int, v int, w string")
    assert h.last_non_null(df, ["k"], ["t"]).first().asDict() == {"k": "a", "t": 3, "v": 5, "w": "x"}
    assert h.latest_version(df.withColumn("row_key", F.lit("r")), written="t").first().t == 3


def test_validation(spark):
    good = observation("p", at(1, 1), 1.0)
    cases = {
        None: good,
        "missing title": (*good[:3], "", *good[4:]),
        "missing price": (*good[:4], None, *good[5:]),
        "missing product_id": (None, *good[1:]),
        "negative price": (*good[:4], -0.5, *good[5:]),
        "missing scraped_at": (*good[:10], None),
    }
    rows = spark.createDataFrame(list(cases.values()), FIELDS)
    valid, refused = st.validate_items(rows)
    assert valid.count() == 1 and {r.reject_reason for r in refused.collect()} == set(cases) - {None}
    zero = spark.createDataFrame([(*good[:4], 0.0, *good[5:])], FIELDS)
    assert st.validate_items(zero)[0].count() == 1
    text = spark.createDataFrame([(*good[:4], "12", *good[5:])], FIELDS.replace("price double", "price string"))
    assert st.validate_items(text)[1].first().reject_reason == "price not numeric"
    payload, bad = st.validate_payload(rows.drop("availability", "category"))
    assert payload.first().availability == "Unknown" and payload.first().pipeline == "unknown"
    assert {r.reject_reason for r in bad.collect()} == {"missing title", "missing price", "missing product_id", "negative price"}


def test_conform_adds_columns(spark):
    df = spark.createDataFrame([("jumia.ma", "A b", "3.5")], "spider string, title string, price string")
    row = st.conform(df).first()
    assert (row.source, row.product_id, row.currency, row.category, row.price) == ("jumia_ma", "a_b_jumia_ma", "GBP", "Unknown", 3.5)
    prices = spark.createDataFrame([("a", "-1"), ("b", "x"), ("c", "NaN"), ("d", "0")], "product_id string, price string")
    assert [r.product_id for r in st.clean_live(prices).collect()] == ["d"]
    bare = st.conform(spark.createDataFrame([("x", "1")], "product_id string, price string")).first()
    assert (bare.source, bare.title) == ("unknown", "x")


def test_ties_are_ordered_by_every_column(spark):
    from tidemark.operators.history import dedupe_daily

    rows = [("p", "2024-01-01 10:00:00", 5.0, rating, cat) for rating in (1.0, 4.0) for cat in ("a", "b")]
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        df = spark.createDataFrame(order, "product_id string, t string, price double, rating double, category string").repartition(3)
        df = df.withColumn("scraped_at", df.t.cast("timestamp")).withColumn("scraped_date", df.t.cast("date")).drop("t")
        assert [(r.rating, r.category) for r in dedupe_daily(df).collect()] == [(4.0, "b")]


def test_payload_without_a_time(spark):
    from tidemark.operators.staging import validate_payload

    rows = spark.createDataFrame([("p", "s", "u", "t", 1.0, "MAD", None)], "product_id string, source string, url string, title string, price double, currency string, scraped_at timestamp")
    good, bad = validate_payload(rows)
    assert good.first().scraped_at is None and good.first().pipeline == "unknown" and bad.count() == 0


def test_white_space_of_any_kind_is_stripped(spark):
    from tidemark.operators.staging import stage_prices

    row = ("p", "s", "u", "\tHP\n", "1", "mad \n", None, "\n", " Phones\t", "", "2024-01-01T00:00:00Z")
    names = "product_id source url title price currency rating availability category image_url scraped_at".split()
    got = stage_prices(spark.createDataFrame([row], ", ".join(f"{n} string" for n in names))).first()
    assert (got.title, got.currency, got.availability, got.category) == ("HP", "MAD", "Unknown", "Phones")
