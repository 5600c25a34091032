import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import special as s
from tidemark.operators import descriptive as d
from tidemark.operators import inference as i
from tidemark.operators.distribution import count_values, mid_ranks, quantiles
from tidemark.operators.sampling import sample_per_group
from tidemark.operators.small import attach, collect_small


def test_published_tail_values():
    assert s.t_two_sided(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert s.t_two_sided(0.0, 5) == 1.0
    assert s.f_sf(2.866081, 4, 20) == pytest.approx(0.05, abs=1e-6)
    assert s.chi2_sf(9.487729, 4) == pytest.approx(0.05, abs=1e-6)
    assert s.chi2_sf(18.307038, 10) == pytest.approx(0.05, abs=1e-6)
    assert s.norm_two_sided(1.959964) == pytest.approx(0.05, abs=1e-6)
    assert s.t_quantile(0.975, 10) == pytest.approx(2.228139, abs=1e-6)
    assert s.t_quantile(0.975, 1e9) == pytest.approx(1.959964, abs=1e-6)
    assert s.t_two_sided(1.959964, 9e6) == pytest.approx(0.05, abs=1e-6)
    assert i.required_n(0.5) == 63 and i.required_n(0.2) == 393 and i.required_n(0.8) == 25


def test_exact_u():
    assert s.u_exact_two_sided(2, 5, 5) == pytest.approx(8 / 252)
    assert s.u_exact_two_sided(12.5, 5, 5) == 1.0
    for n1, n2 in ((3, 4), (2, 6), (1, 5)):
        us = [sum(a > b for a in pick for b in set(range(n1 + n2)) - set(pick)) for pick in itertools.combinations(range(n1 + n2), n1)]
        for u in range(n1 * n2 + 1):
            big = max(u, n1 * n2 - u)
            assert s.u_exact_two_sided(u, n1, n2) == pytest.approx(min(1, 2 * sum(x >= big for x in us) / len(us)))


def test_shapiro_published():
    w, p = s.shapiro_wilk(np.array([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]))
    assert w == pytest.approx(0.78881, abs=1e-4) and p == pytest.approx(0.006704, abs=1e-4)


@pytest.fixture(scope="module")
def prices(spark):
    """Three groups, one with a third of all rows on one value."""
    rng = random.Random(7)
    rows = []
    for n in range(3000):
        g = "abc"[n % 3]
        v = 9.99 if n % 3 == 0 and n % 2 else round(rng.lognormvariate(3, 1), 2)
        rows.append((g, f"{g}{n % 40}", v, n, float(n % 17)))
    df = spark.createDataFrame(rows, "source string, category string, price double, event_id long, rating double")
    return df.withColumn("scraped_at", F.timestamp_seconds("event_id")).withColumn("product_id", F.col("category")), rows


@pytest.mark.parametrize("few,per_bucket", [(10**6, 10), (0, 50), (0, 7)])
def test_quantiles(prices, few, per_bucket):
    df, rows = prices
    probs = {"q0": 0.0, "q1": 0.1, "q25": 0.25, "med": 0.5, "q9": 0.9, "q99": 0.99, "q100": 1.0}
    for r in quantiles(df, ["source"], "price", probs, few, per_bucket).collect():
        want = np.quantile([x[2] for x in rows if x[0] == r.source], list(probs.values()))
        assert [r[k] for k in probs] == pytest.approx(list(want))
    one = quantiles(df, [], "price", probs, few, per_bucket).first()
    assert [one[k] for k in probs] == pytest.approx(list(np.quantile([x[2] for x in rows], list(probs.values()))))


def test_null_labels_and_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None), ("a", 5.0)], "g string, v double")
    for few in (100, 0):
        got = {r.g: r.m for r in quantiles(df, ["g"], "v", {"m": 0.5}, few, 1).collect()}
        assert got == {None: 2.0, "a": 5.0}


def test_quantiles_of_many_groups_copy_no_group(spark):
    """Small groups take no bucket, large ones do, null labels are a group, and no row is copied over salts."""
    rows = spark.range(0, 120_300).select(
        F.when(F.col("id") < 120_000, F.col("id").cast("string")).when(F.col("id") < 120_200, "hot").alias("g"),
        (F.col("id") * 7 % 120_300).cast("double").alias("v"),
    )
    got = quantiles(rows, ["g"], "v", {"m": 0.5, "top": 0.9}, few=1000, per_bucket=500)
    assert "_salt" not in got._jdf.queryExecution().optimizedPlan().toString()
    want = rows.groupBy("g").agg(F.percentile("v", F.lit(0.5)).alias("m"), F.percentile("v", F.lit(0.9)).alias("top"))
    assert got.count() == 120_002 and got.exceptAll(want).isEmpty()


@pytest.mark.parametrize("few", [10**6, 0])
def test_mid_ranks(prices, few):
    df, rows = prices
    values = sorted(x[2] for x in rows)
    ranks = {v: (values.index(v) + 1 + values.index(v) + values.count(v)) / 2 for v in set(values)}
    for r in mid_ranks(count_values(df, ["source"], "price", few, 60)).collect():
        assert r["rank"] == ranks[r.price] and r.ties == values.count(r.price)


def brute_u(a, b):
    return sum((x > y) + 0.5 * (x == y) for x in a for y in b)


@pytest.mark.parametrize("few", [10**6, 0])
def test_mann_whitney(prices, few):
    df, rows = prices
    groups = {g: [x[2] for x in rows if x[0] == g] for g in "abc"}
    for r in i.mann_whitney(df, few=few, per_bucket=40).collect():
        a, b = groups[r.source_a], groups[r.source_b]
        u = brute_u(a, b)
        assert r.u_stat == round(u) or abs(r.u_stat - u) <= 0.5
        assert r.effect_r == pytest.approx(1 - 2 * u / len(a) / len(b), abs=6e-4)
        assert r.median_a == pytest.approx(np.median(a), abs=0.006)


def test_mann_whitney_exact_for_small_groups(spark):
    df = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 5, 7)] + [("b", float(x)) for x in (4, 6, 8, 9, 10)], "source string, price double")
    row = i.mann_whitney(df).first()
    assert row.u_stat == 3 and row.p_value == pytest.approx(2 * 7 / 252, abs=1e-6)


def test_mann_whitney_with_many_groups(spark):
    """More groups than one pass handles: every pair must appear once."""
    rng = random.Random(5)
    rows = [(f"g{n % 37:02d}", float(rng.randrange(30))) for n in range(740)]
    df = spark.createDataFrame(rows, "source string, price double")
    got = {(r.source_a, r.source_b): r.effect_r for r in i.mann_whitney(df).collect()}
    names = sorted({g for g, _ in rows})
    assert set(got) == set(itertools.combinations(names, 2))
    for a, b in (("g00", "g36"), ("g15", "g16"), ("g33", "g34"), ("g16", "g31")):
        va, vb = ([v for g, v in rows if g == x] for x in (a, b))
        assert got[a, b] == pytest.approx(1 - 2 * brute_u(va, vb) / 400, abs=6e-4)


def test_pairs_of_many_groups_in_one_pass(spark):
    """Sums of all pairs, in one bucket or many, in dense blocks of a few values."""
    rng = random.Random(8)
    rows = [(f"g{n % 23:02d}", float(rng.randrange(40))) for n in range(900)]
    df = spark.createDataFrame(rows, "source string, price double")
    names = sorted({g for g, _ in rows})
    for few, per_bucket in ((10**6, 100), (0, 60)):
        counted = count_values(df, ["source"], "price", few, per_bucket)
        assert len(counted.cuts) == 0 if few else len(counted.cuts) > 4
        got = {(names[r.a], names[r.b]): (r.u, r.ties) for r in i.pair_sums(counted, names, block_cells=100).collect()}
        assert set(got) == set(itertools.combinations(names, 2))
        for (a, b), (u, ties) in got.items():
            va, vb = ([v for g, v in rows if g == x] for x in (a, b))
            assert u == brute_u(va, vb)
            assert ties == sum(n**3 - n for n in ((va + vb).count(v) for v in set(va + vb)))


def test_anova_kruskal_levene_welch(prices):
    df, rows = prices
    groups = [np.array([x[2] for x in rows if x[0] == g]) for g in "abc"]
    n, k = sum(map(len, groups)), 3
    grand = np.concatenate(groups).mean()
    ssb = sum(len(g) * (g.mean() - grand) ** 2 for g in groups)
    ssw = sum(((g - g.mean()) ** 2).sum() for g in groups)
    a = i.anova(df).first()
    assert a.f_stat == pytest.approx(ssb / (k - 1) / (ssw / (n - k)), abs=1e-4)
    assert a.eta_sq == pytest.approx(ssb / (ssb + ssw), abs=1e-4)
    away = [np.abs(g - np.median(g)) for g in groups]
    ga = np.concatenate(away).mean()
    f = sum(len(g) * (g.mean() - ga) ** 2 for g in away) / (k - 1) / (sum(((g - g.mean()) ** 2).sum() for g in away) / (n - k))
    assert i.levene(df).first().f_stat == pytest.approx(f, abs=1e-4)
    values = sorted(np.concatenate(groups))
    rank = {v: (values.index(v) + 1 + values.index(v) + values.count(v)) / 2 for v in set(values)}
    h = 12 / (n * (n + 1)) * sum(sum(rank[v] for v in g) ** 2 / len(g) for g in groups) - 3 * (n + 1)
    h /= 1 - sum(values.count(v) ** 3 - values.count(v) for v in set(values)) / (n**3 - n)
    for few in (10**6, 0):
        got = i.kruskal(df, few=few, per_bucket=30).first()
        assert got.h_stat == pytest.approx(h, abs=1e-4) and got.p_value == pytest.approx(math.exp(-h / 2), rel=1e-6)
    w = {(r.source_a, r.source_b): r for r in i.welch_t(df).collect()}
    assert len(w) == 3
    x, y = groups[0], groups[1]
    t = (x.mean() - y.mean()) / math.sqrt(x.var(ddof=1) / len(x) + y.var(ddof=1) / len(y))
    assert w["a", "b"].t_stat == pytest.approx(t, abs=1e-4)


def test_regressions(prices):
    df, rows = prices
    x, y = np.array([r[4] for r in rows]), np.array([r[2] for r in rows])
    slope, intercept = np.polyfit(x, y, 1)
    got = i.linregress(df, "price", "rating").first()
    assert got.slope == pytest.approx(slope, abs=1e-4) and got.intercept == pytest.approx(intercept, abs=0.01)
    assert got.r == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-4)
    days = np.array([r[3] / 86400 for r in rows])
    design = np.column_stack([np.ones(len(x)), x, days])
    beta, rss, *_ = np.linalg.lstsq(design, np.log(y), rcond=None)
    se = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * rss[0] / (len(x) - 3))
    fit = {r.term: r for r in i.log_price_model(df).collect()}
    for term, b, e in zip(("Intercept", "rating", "days_since_start"), beta, se):
        assert fit[term].coef == pytest.approx(b, abs=2e-6) and fit[term].se == pytest.approx(e, abs=2e-6)
    assert i.linregress(df.limit(5), "price", "rating", min_n=10).isEmpty()


def test_effects_and_power(prices):
    df, rows = prices
    a, b = (np.array([x[2] for x in rows if x[0] == g]) for g in "ab")
    want = (a.mean() - b.mean()) / math.sqrt((a.var(ddof=1) + b.var(ddof=1)) / 2)
    got = {(r.source_a, r.source_b): r.cohen_d for r in i.cohens_d(df).collect()}
    assert got["a", "b"] == pytest.approx(want, abs=6e-4)
    assert {r.adequacy for r in i.power_adequacy(df).collect()} == {"OK"}
    assert i.power_adequacy(df.limit(9)).where("adequacy = 'OK'").isEmpty()
    ci = {r.source: r for r in i.confidence_interval(df).collect()}["a"]
    half = s.t_quantile(0.975, len(a) - 1) * a.std(ddof=1) / math.sqrt(len(a))
    assert (ci.ci_lower, ci.ci_upper) == pytest.approx((a.mean() - half, a.mean() + half), abs=0.006)
    matrix = i.p_value_matrix(i.welch_t(df))
    assert matrix.count() == 9 and i.matrix_wide(matrix).count() == 3


def test_central_and_outliers(prices):
    df, rows = prices
    central = {r.source: r for r in d.central_tendency(df).collect()}
    assert central["a"]["mode"] == 9.99 and central[d.OVERALL].n == 3000
    assert central[d.OVERALL].geometric_mean == pytest.approx(math.exp(np.mean(np.log([x[2] for x in rows]))), abs=0.006)
    out = {r.source: r for r in d.outlier_summary(df).collect()}
    for g in "abc":
        v = np.array([x[2] for x in rows if x[0] == g])
        q1, q3 = np.quantile(v, [0.25, 0.75])
        fence = (v < q1 - 1.5 * (q3 - q1)) | (v > q3 + 1.5 * (q3 - q1))
        assert out[g].iqr_outliers == fence.sum()
        assert out[g].z_outliers == (np.abs((v - v.mean()) / v.std()) > 3).sum()
    dens = d.density_grid(df).collect()
    assert len(dens) == 3 * 64 and all(r.density >= 0 for r in dens)


def test_sample_of_copies(spark):
    """A hot group that consists of copies of one row, and a group smaller than the sample."""
    df = spark.range(20_000).select(F.lit("hot").alias("g"), F.lit(1).alias("k")).unionByName(
        spark.range(30).select(F.lit("cold").alias("g"), F.col("id").cast("int").alias("k"))
    )
    got = {r.g: r["count"] for r in sample_per_group(df, "g", ["k"], 100).groupBy("g").count().collect()}
    assert got == {"hot": 100, "cold": 30}
    once, again = (sample_per_group(spark.range(5000).select(F.lit("x").alias("g"), "id"), "g", ["id"], 50).collect() for _ in range(2))
    assert sorted(once) == sorted(again) and len(once) == 50


def test_attach_beyond_the_broadcast_bound(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 10)
    small = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert collect_small(small, 3) is None
    for bound in (3, 100):
        assert attach(df, small, ["k"], max_rows=bound).where("n = 100").count() == 1000
