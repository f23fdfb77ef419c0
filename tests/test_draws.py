"""Draw operators against plain loops, and the shape of their plans."""

import math
import random

import pytest
from plan_text import final_plan

from adtide.operators import posterior

rng = random.Random(5)
WEEKS = {"p": 40, "q": 25}
SPEND = {(p, c): [rng.random() for _ in range(n)] for p, n in WEEKS.items() for c in ("a", "b", "c")[: 3 if p == "p" else 2]}
DRAWS = [(p, k, d, c, rng.random() * 0.9, 0.2 + rng.random(), rng.random()) for (p, c) in SPEND for k in (0, 1) for d in range(6) if (c, d) != ("b", 3)]
GLOBALS = [(p, k, d, *[rng.random() for _ in range(7)]) for p in WEEKS for k in (0, 1) for d in range(6)]
TERMS = ["season_0", "season_1", "season_2", "season_3", "trend", "competitor"]
CALENDAR = {p: [[rng.random() for _ in TERMS] for _ in range(n)] for p, n in WEEKS.items()}


def stock(xs, decay, t, lags=8):
    w = [decay**i for i in range(lags)]
    return sum(x * y for x, y in zip(w, [xs[t - i] if t >= i else 0.0 for i in range(lags)])) / sum(w)


@pytest.fixture(scope="module")
def tables(spark):
    draws = spark.createDataFrame(DRAWS, "panel_id string, chain int, draw bigint, channel string, decay double, sat_k double, beta double")
    shared = spark.createDataFrame(
        GLOBALS, "panel_id string, chain int, draw bigint, intercept double, season_0 double, season_1 double, season_2 double, season_3 double, trend double, comp double"
    )
    series = spark.createDataFrame(
        [(p, c, len(xs), xs, 100.0 if p == "p" else 50.0) for (p, c), xs in SPEND.items()],
        "panel_id string, channel string, n_weeks int, xs array<double>, revenue_mean double",
    )
    week = "struct<t: bigint, season_0: double, season_1: double, season_2: double, season_3: double, trend: double, competitor: double>"
    weekly = spark.createDataFrame([(p, [(t, *w) for t, w in enumerate(ws)]) for p, ws in CALENDAR.items()], f"panel_id string, weeks array<{week}>")
    return draws, shared, series, weekly


def test_expected_revenue_matches_a_loop(tables):
    """A draw without one channel and a panel with fewer channels included."""
    got = {(r["panel_id"], r["chain"], r["draw"], r["t"]): r["mu"] for r in posterior.expected_by_draw(*tables).collect()}
    params = {d[:4]: d[4:] for d in DRAWS}
    assert len(got) == 12 * sum(WEEKS.values())
    for p, k, d, base, *g in GLOBALS:
        for t, terms in enumerate(CALENDAR[p]):
            want = base + sum(x * y for x, y in zip(g, terms))
            for (q, c), xs in SPEND.items():
                if q == p and (p, k, d, c) in params:
                    decay, sat, beta = params[p, k, d, c]
                    want += beta * (1 - math.exp(-stock(xs, decay, t) / sat))
            assert got[p, k, d, t] == pytest.approx(want)


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_draws_and_weeks_are_not_merged_again(spark, tables, threshold):
    """One expansion to weeks, no union, no group by draw and week, with and without broadcasting."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plan = final_plan(posterior.expected_by_draw(*tables))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Generate explode") == 1 and "Union" not in plan
    above = plan[: plan.index("Generate explode")]
    assert "Exchange" not in above and "Aggregate" not in above


@pytest.mark.parametrize("together", [1, 2, 50])
def test_scenarios_share_a_lag_sum(spark, tables, monkeypatch, together):
    monkeypatch.setattr(posterior, "TOGETHER", together)
    draws, _, series, _ = tables
    rows = [(f"s{j}", c, 0.5 + j / 2) for j in range(5) for c in ("a", "b", "c") if (j, c) != (4, "a")]
    scenarios = spark.createDataFrame(rows, "scenario_id string, channel string, m double")
    got = {tuple(r)[:5]: r["revenue"] for r in posterior.channel_revenue(draws, series, scenarios).collect()}
    assert len(got) == sum(1 for d in DRAWS for s in rows if s[1] == d[3])
    for p, k, d, c, decay, sat, beta in DRAWS:
        for s, of, m in rows:
            if of == c:
                scale = 100.0 if p == "p" else 50.0
                want = scale * beta * sum(1 - math.exp(-m * stock(SPEND[p, c], decay, t) / sat) for t in range(WEEKS[p]))
                assert got[s, p, k, d, c] == pytest.approx(want)
    plan = final_plan(posterior.channel_revenue(draws, series, scenarios))
    assert plan.count("Generate explode(sequence") == 1  # weeks are expanded once for all scenarios


def test_expected_revenue_is_formed_outside_the_generated_code(tables):
    """No lag sum or saturation in the expressions of a row of draw and week: with five channels they exceed what
    the JVM compiles. A null among the globals gives null weeks."""
    draws, shared, series, weekly = tables
    rows = posterior.expected_by_draw(draws, shared.replace(GLOBALS[0][3], None, ["intercept"]), series, weekly)
    plan = final_plan(rows)
    assert "EXPM1" not in plan.upper()
    got = {(r["panel_id"], r["chain"], r["draw"]) for r in rows.where("mu IS NULL").collect()}
    assert got == {GLOBALS[0][:3]}
    assert rows.where("mu IS NULL").count() == WEEKS[GLOBALS[0][0]]


def test_weeks_are_summed_under_numbers(spark, tables):
    """The aggregate that a row per draw and week meets has no text among its keys; sums equal a loop."""
    draws, _, series, _ = tables
    longer = series.withColumn("n_weeks", series["n_weeks"] + 2)  # weeks past the array still see its last values
    out = posterior.sum_weeks(draws, longer, [posterior.F.sum("adstock").alias("total")])
    got = {(r["panel_id"], r["chain"], r["draw"], r["channel"]): r["total"] for r in out.collect()}
    assert len(got) == len(DRAWS)
    for p, k, d, c, decay, *_ in DRAWS:
        xs = SPEND[p, c] + [0.0, 0.0]
        assert got[p, k, d, c] == pytest.approx(sum(stock(xs, decay, t) for t in range(len(xs))))
    plan = final_plan(posterior.roi_by_draw(draws, series.withColumn("spend_total", posterior.F.lit(1.0))))
    above = plan[: plan.index("Generate explode(sequence")].splitlines()
    nearest = [line for line in above if "Aggregate(" in line][-1]
    assert "panel_id" not in nearest.split("functions=")[0] and "channel" not in nearest.split("functions=")[0]
