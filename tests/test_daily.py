"""Daily states, their table by loads, rolling features and the bucketed families."""

import datetime as dt
import math
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark.operators import daily
from tidemark.sources import daily_table, families

SCHEMA = "event_id long, product_id string, scraped_at timestamp, price double"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for n in range(3000):
        product = "hot" if rng.random() < 0.5 else f"p{rng.randrange(6)}"
        at = dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randrange(60) if product != "p5" else 20 * rng.randrange(4), minutes=rng.randrange(1440))
        # Large prices that hardly change: sums of plain squares would lose the deviation.
        out.append((n, product, at, 1e7 + rng.randrange(500) / 100))
    return [*out, (-1, "p1", None, 5.0), (-2, None, dt.datetime(2024, 1, 2), 5.0), (-3, "p1", dt.datetime(2024, 1, 2), None), (-4, "p1", dt.datetime(2024, 1, 2), math.nan)]


@pytest.fixture(scope="module")
def prices(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def plain(rows):
    by = {}
    for _, product, at, price in rows:
        if product and at and price is not None and not math.isnan(price):
            by.setdefault((product, at.date()), []).append((at, price))
    return by


def test_states(prices, rows):
    got = {(r.product_id, r.scraped_date): r for r in daily.daily_price_stats(daily.daily_states(prices)).collect()}
    want = plain(rows)
    assert got.keys() == want.keys()
    for key, seen in want.items():
        values, r = [p for _, p in seen], got[key]
        assert (r.observations, r.min_price, r.max_price) == (len(values), min(values), max(values))
        assert (r.open_price, r.close_price) == (min(seen)[1], max(seen)[1])
        assert r.stddev_price == (pytest.approx(statistics.stdev(values), abs=0.006) if len(values) > 1 else None)


def test_rolling_features(prices, rows):
    by = plain(rows)
    got = daily.rolling_features(daily.daily_states(prices)).collect()
    assert {(r.product_id, r.scraped_date) for r in got} == set(by)
    for r in got:
        days = {k: [p for (product, day), seen in by.items() if product == r.product_id and 0 <= (r.scraped_date - day).days < k for _, p in seen] for k in (7, 30)}
        wide = days[30]
        assert r.avg_7d == pytest.approx(statistics.fmean(days[7]), abs=0.006) and r.avg_30d == pytest.approx(statistics.fmean(wide), abs=0.006)
        assert (r.min_30d, r.max_30d) == (min(wide), max(wide))
        assert r.volatility == (pytest.approx(statistics.stdev(wide), abs=0.006) if len(wide) > 1 else None)


def test_one_exchange_by_product(prices):
    plan = daily.rolling_features(daily.daily_states(prices))._jdf.queryExecution().executedPlan().toString()
    keys = [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)]
    # The states by product and day, combined before; the windows by product.
    assert sorted(keys) == ["product_id", "product_id, scraped_date"] and "partial_count" in plan


def test_latest_features_are_those_of_the_last_day(prices):
    states = daily.daily_states(prices)
    last = {r.product_id: r for r in daily.latest_features(states, "2024-02-29").collect()}
    rolled = {r.product_id: r for r in daily.rolling_features(states).where("scraped_date = '2024-02-29'").collect()}
    assert rolled and all((last[p].avg_7d, last[p].avg_30d, last[p].max_30d) == (r.avg_7d, r.avg_30d, r.max_30d) for p, r in rolled.items())


def files_of(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_loads_give_the_whole(spark, prices, tmp_path):
    whole = {(r.product_id, r.scraped_date): r for r in daily.daily_states(prices).collect()}
    for k in range(3):
        assert daily_table.load_days(prices.where(F.pmod("event_id", F.lit(3)) == k), str(tmp_path / "t"), f"l{k}")
    got = daily_table.read_days(spark, str(tmp_path / "t")).collect()
    assert len(got) == len(whole)
    for r in got:
        w = whole[r.product_id, r.scraped_date]
        assert (r.n, r.total, r.low, r.high, r.opened, r.closed) == (w.n, w.total, w.low, w.high, w.opened, w.closed)
        assert r.m2 == pytest.approx(w.m2, abs=1e-6)
    assert not daily_table.load_days(prices, str(tmp_path / "t"), "l1")
    assert daily_table.read_loads(spark, str(tmp_path / "t")).count() == 3


def test_other_days_keep_their_files(spark, prices, tmp_path):
    path = str(tmp_path / "t")
    daily_table.load_days(prices, path, "a")
    before = files_of(tmp_path / "t" / "table")
    daily_table.load_days(prices.where("to_date(scraped_at) = '2024-01-09'"), path, "b")
    after = files_of(tmp_path / "t" / "table")
    changed = {k.split("/")[0] for k in before.keys() ^ after.keys()} | {k.split("/")[0] for k in before.keys() & after.keys() if before[k] != after[k]}
    assert changed == {"scraped_date=2024-01-09"}


def test_a_load_that_died_is_given_again(spark, prices, tmp_path):
    """Died after the merged days were complete: the days are swapped once more, not merged twice."""
    path = str(tmp_path / "t")
    daily_table.load_days(prices, path, "a")
    rows = daily_table.read_days(spark, path).agg(F.sum("n")).first()[0]
    (tmp_path / "t" / "loads" / "load=a").rename(tmp_path / "lost")
    assert daily_table.load_days(prices, path, "a")
    assert daily_table.read_days(spark, path).agg(F.sum("n")).first()[0] == rows


def test_families_are_joined_in_place(spark, tmp_path):
    data = [(f"p{0 if n % 3 else n % 20}", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=n), float(n), "EUR", f"t{n}" if n % 2 else None, None, None, f"u{n}", "s") for n in range(900)]
    df = spark.createDataFrame(data, "product_id string, scraped_at timestamp, price double, currency string, title string, category string, rating double, url string, source string")
    families.write_families(df, "family_test", ["scraped_at"], buckets=8, salts=4)
    joined = families.prices_with_metadata(spark, "family_test")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    titles, urls = {}, {}
    for row in data:
        titles[row[0]] = row[4] or titles.get(row[0])
        urls[row[0]] = row[7]
    got = joined.collect()
    assert len(got) == 900 and all((r.title, r.url) == (titles[r.product_id], urls[r.product_id]) for r in got)
    hot = spark.table("family_test_prices").where("product_id = 'p0'").select("salt").distinct().count()
    assert hot == 4
