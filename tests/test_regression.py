"""Residuals of a fit, per key."""

import numpy as np
import pytest

from adtide.operators import regression


def test_residuals_equal_a_direct_solve(spark):
    rng = np.random.default_rng(4)
    rows = [(k, *map(float, rng.normal(size=2)), float(rng.normal())) for k in ("a", "b") for _ in range(30)]
    df = spark.createDataFrame(rows, "key string, x1 double, x2 double, y double")
    fit = regression.ols_fit(df, "key", ["x1", "x2"], "y")
    got = regression.residuals(df, fit, "key", ["x1", "x2"], "y").collect()
    assert len(got) == len(rows)
    for key in ("a", "b"):
        mine = [r for r in got if r["key"] == key]
        x = np.array([[1.0, r["x1"], r["x2"]] for r in mine])
        y = np.array([r["y"] for r in mine])
        want = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
        assert [r["residual"] for r in mine] == pytest.approx(want.tolist(), abs=1e-9)
        assert [r["fitted"] + r["residual"] for r in mine] == pytest.approx(y.tolist())


def test_rows_without_a_fit_are_left_out(spark):
    df = spark.createDataFrame([("a", float(i), float(i * i)) for i in range(5)], "key string, x double, y double")
    more = df.union(spark.createDataFrame([("z", 1.0, 1.0)], df.schema))
    fit = regression.ols_fit(df, "key", ["x"], "y")
    assert regression.residuals(more, fit, "key", ["x"], "y").count() == 5


def test_ill_conditioned_terms(spark):
    """Terms with a condition number of about 1e9, which sums of squares cannot tell apart."""
    rng = np.random.default_rng(8)
    n = 4000
    a = rng.normal(size=n)
    x = np.column_stack([a, a + 1e-9 * rng.normal(size=n), 10 + rng.normal(size=n)])
    y = 3.0 + x[:, 0] - 2.0 * x[:, 1] + 0.5 * x[:, 2]
    rows = [("k", *map(float, r), float(v)) for r, v in zip(x, y)]
    df = spark.createDataFrame(rows, "key string, a double, b double, c double, y double").repartition(7)
    fit = {r["term"]: r for r in regression.ols_fit(df, "key", ["a", "b", "c"], "y").collect()}
    design = np.column_stack([np.ones(n), x])
    want = np.linalg.lstsq(design, y, rcond=None)[0]
    assert fit["a"]["coef"] == pytest.approx(1.0, abs=1e-4) and want[1] == pytest.approx(1.0, abs=1e-4)
    assert fit["b"]["coef"] == pytest.approx(-2.0, abs=1e-4)
    assert fit["c"]["coef"] == pytest.approx(0.5, abs=1e-9) and fit["a"]["r2"] == pytest.approx(1.0)


def test_fit_against_a_direct_solve(spark):
    """Many keys and tasks, a constant term, a collinear term, too few rows, null rows and a null key."""
    rng = np.random.default_rng(9)
    rows = []
    for key in [*(f"k{i}" for i in range(40)), None]:
        for _ in range(60):
            a, b = map(float, rng.normal(size=2))
            rows.append((key, a, b, 2 * a - 3 * b, 5.0, float(1 + 2 * a - b + rng.normal())))
    rows += [("k0", None, 1.0, 1.0, 5.0, 1.0), ("k1", 1.0, 1.0, 1.0, 5.0, None), ("few", 1.0, 2.0, -4.0, 5.0, 3.0)]
    df = spark.createDataFrame(rows, "key string, a double, b double, both double, flat double, y double").repartition(9)
    fit = {(r["key"], r["term"]): r for r in regression.ols_fit(df, "key", ["a", "b", "both", "flat"], "y").collect()}
    assert len(fit) == 42 * 5
    for key in ["k0", "k7", None]:
        mine = np.array([r[1:] for r in rows if r[0] == key and None not in r[1:]])
        x = np.column_stack([np.ones(len(mine)), mine[:, :2]])
        b, sse = np.linalg.lstsq(x, mine[:, 4], rcond=None)[:2]
        got = fit[key, "a"]
        assert got["sse"] == pytest.approx(float(sse[0])) and got["n"] == len(mine)
        eff = [fit[key, "a"]["coef"] + 2 * fit[key, "both"]["coef"], fit[key, "b"]["coef"] - 3 * fit[key, "both"]["coef"]]
        assert [fit[key, "const"]["coef"], *eff] == pytest.approx(b.tolist())
        assert fit[key, "flat"]["coef"] == 0 and fit[key, "flat"]["std_error"] is None
        plain = {r["term"]: r for r in regression.ols_fit(df.where(df["key"].eqNullSafe(key)), "key", ["a", "b"], "y").collect()}
        s2 = float(sse[0]) / (len(mine) - 3)
        err = np.sqrt(s2 * np.diag(np.linalg.inv(x.T @ x)))
        assert [plain[t]["std_error"] for t in ("const", "a", "b")] == pytest.approx(err.tolist())
    assert fit["few", "const"]["coef"] == pytest.approx(3.0)
