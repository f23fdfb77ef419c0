import math

from pyspark.sql import functions as F

from adtide import functions as fn


def column(spark, n, expr):
    return [r[0] for r in spark.range(n).select(expr).collect()]


def test_hill_range_half_and_order(spark):
    x = F.col("id") * 1000.0 / 49
    ys = column(spark, 50, fn.hill_saturation(x, 2.0, 200.0))
    assert all(0 <= y < 1 for y in ys)
    assert column(spark, 1, fn.hill_saturation(F.lit(150.0), 2.5, 150.0)) == [0.5]
    rising = sorted(column(spark, 100, fn.hill_saturation(F.col("id") * 5.0 + 1, 1.8, 120.0)))
    assert all(a < b for a, b in zip(rising, rising[1:]))


def test_hill_zero_channel_and_negative(spark):
    assert column(spark, 1, fn.hill_saturation(F.lit(0.0), 2.0, 0.0)) == [0.0]
    assert column(spark, 1, fn.hill_saturation(F.lit(-5.0), 2.0, 3.0)) == [0.0]


def test_exponential(spark):
    e = lambda x, k: column(spark, 1, fn.exponential_saturation(F.lit(x), k))[0]
    assert e(0.0, 0.5) == 0
    assert 0.999 < e(1e6, 0.5) <= 1
    assert e(2.0, 1.0) - e(1.0, 1.0) < e(1.0, 1.0)


def test_fourier(spark):
    rows = spark.range(104).select("id", *fn.fourier_terms(F.col("id"))).collect()
    assert len(rows[0]) == 5
    for r in rows:
        for h in (1, 2):
            angle = 2 * math.pi * h * r["id"] / 52.18
            assert math.isclose(r[f"season_{2 * h - 2}"], math.sin(angle), abs_tol=1e-12)
            assert math.isclose(r[f"season_{2 * h - 1}"], math.cos(angle), abs_tol=1e-12)


def test_lag_weights_sum_to_one(spark):
    ws = spark.range(1).select(*fn.lag_weights(F.lit(0.6))).first()
    assert len(ws) == 8 and math.isclose(sum(ws), 1) and math.isclose(ws[1] / ws[0], 0.6)
    assert tuple(spark.range(1).select(*fn.lag_weights(F.lit(0.0))).first()) == (1,) + (0,) * 7


def test_rules(spark):
    marks = [column(spark, 1, fn.change_marker(F.lit(m)))[0] for m in (1.03, 1.02, 0.98, 0.97)]
    assert marks == ["up", "equal", "equal", "down"]
    verdict = lambda s, u: column(
        spark, 1, fn.scenario_verdict(F.lit(s), F.lit(100.0), F.lit(u))
    )[0]
    assert [verdict(106.0, 9.0), verdict(104.0, 9.0), verdict(95.5, -1.0)] == [
        "warning", "improves", "no_gain",
    ]
    assert column(spark, 3, fn.clip(F.col("id").cast("double"), 0.5, 1.5)) == [0.5, 1.0, 1.5]
    assert column(spark, 1, fn.safe_ratio(F.lit(3.0), F.lit(0.0))) == [0.0]
