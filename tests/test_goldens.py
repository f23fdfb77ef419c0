"""The weekly advertiser file: published results and values recomputed from it."""

import datetime
import math
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from adtide.operators import allocation, panel, regression
from adtide.operators.regression import student_quantile, student_two_sided
from adtide.plans.inputs import values_table
from adtide.plans.jobs import media_job
from adtide.sources import read_weekly_csv, weekly_cells
from adtide.sources.weekly import WEEKLY_SCHEMA



# The published numbers need the advertiser's own file.
WEEKLY = os.environ.get("WEEKLY_CSV", "")
needs_file = pytest.mark.skipif(not os.path.exists(WEEKLY), reason="WEEKLY_CSV is not set")

# Channel, decay, alpha, k_pct.
PARAMS = [
    ("tv", 0.65, 2.5, 0.50), ("ooh", 0.55, 2.0, 0.50), ("print", 0.45, 1.8, 0.40),
    ("facebook", 0.20, 1.5, 0.30), ("search", 0.05, 1.3, 0.30),
]
CHANNELS = [p[0] for p in PARAMS]


WEEKS = 104


@pytest.fixture(scope="module")
def made_csv(tmp_path_factory):
    """A weekly file with known effects: revenue is a base plus 3 EUR for each EUR on search."""
    rng = np.random.default_rng(11)
    names = WEEKLY_SCHEMA.names
    path = tmp_path_factory.mktemp("weekly") / "made.csv"
    with open(path, "w") as f:
        f.write(",".join(names) + "\n")
        for t in range(WEEKS):
            spend = {f"{c}_S": round(float(rng.gamma(2, 1000)) * (rng.random() < 0.7), 2) for c in CHANNELS}
            day = np.datetime64("2018-01-01") + 7 * t
            row = {"DATE": day, "revenue": 100_000 + 3 * spend["search_S"], "competitor_sales_B": 5_000_000 + 1000 * t, "events": "na", **spend}
            f.write(",".join(str(row.get(n, 0)) for n in names) + "\n")
    return str(path)


def closed_draws(spark, n=200):
    """Draws around known values, two chains that agree, and one channel with the largest effect."""
    base = spark.range(2 * n).select(
        F.lit("advertiser").alias("panel_id"), (F.col("id") % 2).cast("int").alias("chain"), F.floor(F.col("id") / 2).cast("int").alias("draw"),
        ((F.col("id") * 37) % 101 / 1000).alias("e"),
    )
    channels = values_table(spark, "channel, decay0, beta0", [(c, 0.1 * i + 0.1, 0.02 + 0.1 * (c == "search")) for i, c in enumerate(CHANNELS)])
    draws = base.join(channels).select(
        "panel_id", "chain", "draw", "channel", (F.col("decay0") + F.col("e")).alias("decay"), (0.5 + F.col("e")).alias("sat_k"), (F.col("beta0") + F.col("e") / 10).alias("beta"),
    )
    shared = base.select("panel_id", "chain", "draw", (0.9 + F.col("e")).alias("intercept"), (0.1 + F.col("e")).alias("sigma"))
    return draws, shared


@pytest.fixture(scope="module")
def made(spark, made_csv, tmp_path_factory):
    cells = weekly_cells(read_weekly_csv(spark, made_csv))
    params = values_table(spark, "channel, decay, alpha, k_pct", PARAMS)
    draws, shared = closed_draws(spark)
    divergences = values_table(spark, "panel_id, divergences", [("advertiser", 3)])
    out = str(tmp_path_factory.mktemp("made"))
    return media_job(cells, params, CHANNELS, draws, shared, divergences, out) | {"out": out}


def test_media_job_on_a_made_file(spark, made):
    fit = by(made["naive_fit"], "term")
    assert fit["spend_search"]["coef"] == pytest.approx(3, rel=1e-6) and fit["const"]["coef"] == pytest.approx(100_000, rel=1e-6)
    assert fit["spend_tv"]["coef"] == pytest.approx(0, abs=1e-6)
    check = made["convergence"].first()
    assert check["converged"] and check["divergences"] == 3
    roi = by(made["roi"], "channel")
    assert set(roi) == set(CHANNELS) and max(roi, key=lambda c: roi[c]["roi_mean"]) == "search"
    assert all(r["roi_lo"] <= r["roi_mean"] <= r["roi_hi"] for r in roi.values())
    assert set(by(made["allocation"], "channel")) == set(CHANNELS)
    assert by(made["uplift"], "scenario_id")["recommended"]["mean"] > 0
    assert spark.read.csv(f"{made['out']}/roi_csv", header=True).count() == 5
    assert spark.read.parquet(f"{made['out']}/draws").count() == 400 * 5


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    cells = weekly_cells(read_weekly_csv(spark, WEEKLY))
    params = values_table(spark, "channel, decay, alpha, k_pct", PARAMS)
    draws, shared = closed_draws(spark)
    divergences = values_table(spark, "panel_id, divergences", [("advertiser", 3)])
    return media_job(cells, params, CHANNELS, draws, shared, divergences, str(tmp_path_factory.mktemp("media")))


def by(df, key):
    return {r[key]: r for r in df.collect()}


@needs_file
def test_profile_and_shares(spark):
    weekly = read_weekly_csv(spark, WEEKLY)
    row = weekly.agg(F.count("*"), F.min("DATE").cast("string"), F.max("DATE").cast("string"), F.sum("revenue")).first()
    assert row[:3] == (208, "2015-11-23", "2019-11-11")
    assert row[3] == pytest.approx(379_005_696.666667)
    shares = by(panel.budget_share(panel.densify(weekly_cells(weekly))), "channel")
    want = {"tv": 21.250374, "ooh": 61.871228, "print": 5.337947, "facebook": 3.071745, "search": 8.468706}
    assert {c: r["share_pct"] for c, r in shares.items()} == pytest.approx(want, abs=1e-5)
    assert sum(r["spend_total"] for r in shares.values()) == pytest.approx(14_529_098.512314)


@needs_file
def test_naive_fit(tables):
    fit = by(tables["naive_fit"], "term")
    want = {"const": 1115815.85, "spend_tv": 7.807726, "spend_ooh": 0.976936, "spend_print": 14.521552,
            "spend_facebook": 60.676949, "spend_search": 61.511621}
    assert {t: r["coef"] for t, r in fit.items()} == pytest.approx(want, rel=1e-6)
    one = fit["const"]
    assert one["r2"] == pytest.approx(0.435768, abs=1e-6)
    assert one["adj_r2"] == pytest.approx(0.421802, abs=1e-6)
    assert one["aic"] == pytest.approx(6090.6497, abs=1e-3)
    assert one["bic"] == pytest.approx(6110.6750, abs=1e-3)


@needs_file
def test_model_fit_roi_and_base(tables):
    roi = {c: r["roi"] for c, r in by(tables["model_roi"], "channel").items()}
    want = {"tv": 5.541, "ooh": 0.469, "print": 8.336, "facebook": 15.814, "search": 0.287}
    assert roi == pytest.approx(want, abs=6e-4)
    stats = regression.fit_stats(regression.fitted_residuals(tables["contributions"]), 12).first()
    assert stats["r2"] == pytest.approx(0.869643, abs=1e-6)
    assert stats["durbin_watson"] == pytest.approx(2.066506, abs=1e-6)
    base = regression.base_share(tables["contributions"]).first()["base_pct"]
    assert base == pytest.approx(90.7132, abs=1e-4)


def test_student_distribution():
    # two-sided 5 percent points from standard tables
    for dof, t in ((1, 12.706205), (2, 4.302653), (10, 2.228139), (202, 1.971777)):
        assert student_quantile(0.05, dof) == pytest.approx(t, abs=1e-5)
        assert student_two_sided(np.array(-t), dof) == pytest.approx(0.05, abs=1e-6)


def test_student_cost_does_not_grow():
    start = time.perf_counter()
    assert student_quantile(0.05, 10**8) == pytest.approx(1.959964, abs=1e-5)
    assert student_quantile(0.05, 34_001) == pytest.approx(1.960028, abs=1e-5)
    assert student_two_sided(np.array([0.0, 1.0, np.nan]), 5)[:2] == pytest.approx([1, 0.363217], abs=1e-5)
    assert time.perf_counter() - start < 1


def test_collinear_terms_count_once(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 2))
    rows = [("p", float(a), float(b), 2 * float(a), float(1 + a - b + e)) for (a, b), e in zip(x, rng.normal(size=60), strict=True)]
    df = spark.createDataFrame(rows, "panel_id string, x1 double, x2 double, x3 double, y double")
    full, less = (regression.ols_fit(df, "panel_id", xs, "y").where("term = 'x2'").first() for xs in (["x1", "x2", "x3"], ["x1", "x2"]))
    for name in ("coef", "std_error", "r2", "adj_r2", "aic", "bic", "ci_lo"):
        assert full[name] == pytest.approx(less[name], rel=1e-6)


def test_densify_sums_and_refuses(spark):
    schema = "panel_id string, channel string, week date, spend double, revenue double, competitor double"
    day = lambda s: datetime.date.fromisoformat(s)
    rows = [("p", "a", day("2020-01-06"), 1.0, 2.0, 0.0), ("p", "a", day("2020-01-06"), 3.0, 4.0, 0.0), ("p", "a", day("2020-01-20"), 5.0, 6.0, 0.0)]
    got = panel.densify(spark.createDataFrame(rows, schema)).orderBy("t").collect()
    assert [(r["spend"], r["n_weeks"]) for r in got] == [(4.0, 3), (0.0, 3), (5.0, 3)]
    rows.append(("p", "a", day("2020-01-15"), 1.0, 1.0, 0.0))
    with pytest.raises(Exception, match="whole number of weeks"):
        panel.densify(spark.createDataFrame(rows, schema)).collect()


def mean_rows(spark, rows):
    return spark.createDataFrame(
        rows, "panel_id string, channel string, spend_total double, revenue_mean double, "
        "sat_k double, beta double, stock array<double>",
    )


def test_allocation_against_fine_search(spark):
    """Interior optimum, unequal channel costs, a channel without spend; both constraints hold."""
    stocks = {"a": [0.2, 0.5, 0.9], "b": [0.4, 0.4, 0.4], "z": [0.0, 0.0, 0.0]}
    rows = [("p", "a", 10.0, 100.0, 0.3, 0.8, stocks["a"]), ("p", "b", 400.0, 100.0, 0.6, 9.0, stocks["b"]),
            ("p", "z", 0.0, 100.0, 0.5, 1.0, stocks["z"])]
    got = by(allocation.budget_allocation(mean_rows(spark, rows)), "channel")
    revenue = lambda m, k, b, s: 100 * b * sum(1 - math.exp(-m * x / k) for x in s)
    best = max(
        (revenue(m, 0.3, 0.8, stocks["a"]) + revenue((410 - 10 * m) / 400, 0.6, 9.0, stocks["b"]), m)
        for m in (0.3 + i * 1.7 / 200_000 for i in range(200_001))
    )[1]
    ma, mb = got["a"]["multiplier"], got["b"]["multiplier"]
    assert 10 * ma + 400 * mb == pytest.approx(410, rel=1e-9)
    assert ma == pytest.approx(best, abs=0.02) and got["z"]["multiplier"] == 1
    assert mb == pytest.approx((410 - 10 * best) / 400, abs=1e-3)


def optimality_gap(rows, got, lo=0.3, hi=2.0):
    """Largest relative breach of the optimality conditions of one panel's plan."""
    price = {}
    for _, c, spend, rev, k, beta, stock in rows:
        if spend:
            m = got[c]["multiplier"]
            price[c] = rev * beta / k / spend * sum(a * math.exp(-m * a / k) for a in stock)
            if price[c]:
                assert got[c]["marginal"] == pytest.approx(price[c], rel=1e-12)
    inner = [c for c in price if lo < got[c]["multiplier"] < hi]
    level = [price[c] for c in inner] or [max(price.values())]
    worst = max(level) / min(level) - 1 if min(level) else 0.0
    for c in price:
        if got[c]["multiplier"] == lo:  # a further EUR may not be worth more than elsewhere
            worst = max(worst, price[c] / min(level) - 1 if min(level) else 0.0)
        if got[c]["multiplier"] == hi:
            worst = max(worst, 1 - price[c] / max(level) if max(level) else 0.0)
    spent, budget = sum(r[2] * got[r[1]]["multiplier"] for r in rows), sum(r[2] for r in rows)
    return max(worst, abs(spent - budget) / budget if budget else 0.0)


def test_optimal_allocation_meets_the_conditions(spark):
    """Random panels, bounds that bind, equal channels, channels without spend, revenue or weeks."""
    rng = np.random.default_rng(5)
    panels = {
        f"r{i}": [
            (f"r{i}", f"c{j}", float(rng.lognormal(3, 2)), 1e6, float(rng.lognormal(-1, 1)), float(rng.lognormal(-1, 1)),
             rng.uniform(0, 1, 1 + 13 * (i % 4)).tolist())
            for j in range(2 + i % 6)
        ]
        for i in range(30)
    }
    s = [0.2, 0.9, 0.4]
    panels["equal"] = [("equal", c, 5.0, 10.0, 0.4, 1.0, s) for c in "abc"]
    panels["flat"] = [("flat", "a", 5.0, 10.0, 0.4, 0.0, s), ("flat", "b", 5.0, 10.0, 0.4, 0.0, [])]
    panels["steep"] = [("steep", "a", 900.0, 1e6, 0.02, 1.0, [1.0, 1e-3, 0.05]), ("steep", "b", 90.0, 1e6, 5.0, 1.0, s)]
    panels["mixed"] = [("mixed", "a", 5.0, 10.0, 0.4, 1.0, s), ("mixed", "b", 50.0, 10.0, 0.4, 0.0, s), ("mixed", "z", 0.0, 10.0, 0.4, 1.0, s)]
    panels["none"] = [("none", "a", 0.0, 10.0, 0.4, 1.0, s)]
    got = {p: {} for p in panels}
    best = allocation.optimal_allocation(mean_rows(spark, [r for rows in panels.values() for r in rows]))
    for r in best.collect():
        got[r["panel_id"]][r["channel"]] = r
    for p, rows in panels.items():
        assert set(got[p]) == {r[1] for r in rows}
        assert all(0.3 <= r["multiplier"] <= 2.0 for r in got[p].values())
        if p != "none":
            assert optimality_gap(rows, got[p]) < 1e-9, p
    assert got["none"]["a"]["multiplier"] == got["mixed"]["z"]["multiplier"] == 1
    assert got["mixed"]["z"]["marginal"] is None
    assert all(r["multiplier"] == pytest.approx(1.0) for r in got["equal"].values())
    assert allocation.optimal_allocation(mean_rows(spark, [])).count() == 0


def test_greedy_fill_is_close_to_the_optimum(spark):
    rows = [("p", c, 10.0 + 40 * i, 1e4, 0.3 + 0.2 * i, 0.5, [0.1, 0.4, 0.8]) for i, c in enumerate("abc")]
    exact = by(allocation.optimal_allocation(mean_rows(spark, rows)), "channel")
    fill = by(allocation.budget_allocation(mean_rows(spark, rows)), "channel")
    budget = sum(r[2] for r in rows)
    for r in rows:
        assert abs(exact[r[1]]["multiplier"] - fill[r[1]]["multiplier"]) * r[2] < 2 * 1.7 / 340 / 340 * budget * len(rows)


def test_revenue_rises_and_bends(spark):
    curve = allocation.response_curve(
        mean_rows(spark, [("p", "a", 1.0, 2.5e6, 0.4, 0.1, [0.3, 0.5, 0.2, 0.6])]), points=3
    ).orderBy("step").collect()
    r = [c["revenue"] for c in curve]
    assert r[0] == 0 < r[1] < r[2] and r[2] - r[1] < r[1] - r[0]
