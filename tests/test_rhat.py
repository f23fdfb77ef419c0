"""Rank-normalised R-hat and normal quantiles against the standard library and NumPy."""

from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from adtide.functions.normal import probit
from adtide.operators import posterior

INV = NormalDist().inv_cdf


def test_normal_quantiles(spark):
    ps = [1e-300, 1e-20, 1e-12, 1e-6, 0.01, 0.0749, 0.075, 0.3, 0.5, 0.7, 0.925, 0.9251, 0.99, 1 - 1e-12]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select("p", probit("p").alias("z")).collect()
    for r in got:
        assert r["z"] == pytest.approx(INV(r["p"]), rel=1e-13, abs=1e-15)


def zscale(x):
    flat = x.ravel()
    order = np.sort(flat)
    mid = (np.searchsorted(order, flat, "left") + 1 + np.searchsorted(order, flat, "right")) / 2
    return np.array([INV(p) for p in (mid - 0.375) / (flat.size + 0.25)]).reshape(x.shape)


def plain(x):
    """Split R-hat of (chains, draws) with an even number of draws."""
    n = x.shape[1] // 2
    halves = np.concatenate([x[:, :n], x[:, n:]])
    within = halves.var(axis=1, ddof=1).mean()
    return np.sqrt(((n - 1) / n * within + halves.mean(axis=1).var(ddof=1)) / within)


def want(x):
    return max(plain(zscale(x)), plain(zscale(np.abs(x - np.median(x)))))


def test_rank_rhat_matches_numpy(spark):
    """4 chains of 1,000 draws: agreeing, shifted, of different width, heavy-tailed, with many ties."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(4, 1000))
    cases = {
        "same": base, "shift": base + np.array([[0], [0], [0], [1.5]]), "width": base * np.array([[1], [1], [1], [4]]),
        "heavy": rng.standard_cauchy(size=(4, 1000)), "ties": np.round(base), "drift": base + np.linspace(0, 2, 1000),
    }
    rows = [("p", c, d, name, float(x[c, d])) for name, x in cases.items() for c in range(4) for d in range(1000)]
    rows += [("q", c, d, "same", float(base[c, d])) for c in range(4) for d in range(1000)] + [("q", 0, 5, "none", None)]
    df = spark.createDataFrame(rows, "panel_id string, chain int, draw bigint, param string, value double").repartition(6)
    got = {(r["panel_id"], r["param"]): r for r in posterior.rank_rhat(df).collect()}
    assert set(got) == {("q", "same")} | {("p", n) for n in cases}
    for name, x in cases.items():
        assert got["p", name]["rhat"] == pytest.approx(want(x), rel=1e-10) and got["p", name]["halves"] == 8
    assert got["q", "same"]["rhat"] == pytest.approx(got["p", "same"]["rhat"], rel=1e-12)
    simple = {r["param"]: r["rhat"] for r in posterior.split_rhat(df.where(F.col("panel_id") == "p")).collect()}
    assert got["p", "width"]["rhat"] > 1.1 > 1.02 > simple["width"]  # only the folded ranks see it


def test_rows_are_not_sent_to_the_ranks(spark):
    """Many rows of few values are small on disk: the ranks go to the rows, not the other way round."""
    from plan_text import final_plan

    df = spark.range(200_000).selectExpr("id % 3 AS k", "CAST(id % 7 AS DOUBLE) AS value", "id % 4 AS chain")
    out = posterior.rank_normalised(df, ["k"], "value")
    plan = final_plan(out)
    assert "BroadcastHashJoin" in plan and "Window" not in plan
    build = plan[plan.index("BroadcastHashJoin") :].splitlines()[0]
    assert "BuildRight" in build and out.count() == 200_000
