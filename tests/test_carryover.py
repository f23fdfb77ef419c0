import random

import pytest
from pyspark.sql import functions as F

from adtide.operators import carryover, panel, posterior
from adtide.plans.inputs import values_table

DAY = "date'2020-01-06'"


def series(spark, points):
    """(channel, spends) -> dense panel rows of panel p."""
    rows = [(c, i, float(x)) for c, xs in points for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, "channel string, t bigint, spend double").select(
        F.lit("p").alias("panel_id"), "channel",
        F.expr(f"date_add({DAY}, cast(t * 7 as int))").alias("week"), "t", "spend",
        F.lit(0.0).alias("revenue"), F.lit(0.0).alias("competitor"),
    )


def loop(xs, d):
    out = []
    for x in xs:
        out.append(x + d * (out[-1] if out else 0))
    return out


@pytest.mark.parametrize("length,decay", [(4, 0.0), (4, 0.5), (1, 0.9), (64, 0.3), (65, 0.3),
                                          (1500, 0.99), (1500, 1e-9), (300, 0.65)])
def test_recursive_matches_loop(spark, length, decay):
    rng = random.Random(length)
    xs = [rng.uniform(0, 1e5) if rng.random() < 0.4 else 0.0 for _ in range(length)]
    params = values_table(spark, "channel, decay", [("a", decay)])
    rows = carryover.adstock_geometric(series(spark, [("a", xs)]), params).orderBy("t").collect()
    assert len(rows) == length
    for row, want in zip(rows, loop(xs, decay)):
        assert row["adstock"] == pytest.approx(want, rel=1e-12, abs=1e-9)
        assert row["adstock"] >= row["spend"]


def test_impulse_and_separate_series(spark):
    params = values_table(spark, "channel, decay", [("a", 0.5), ("b", 0.0)])
    p = series(spark, [("a", [1, 0, 0, 0]), ("b", [10, 5, 0, 8])])
    rows = carryover.adstock_geometric(p, params).orderBy("channel", "t").collect()
    assert [r["adstock"] for r in rows] == [1, 0.5, 0.25, 0.125, 10, 5, 0, 8]


def test_lag_vector(spark):
    p = series(spark, [("a", [1, 2, 3, 4])])
    rows = p.select("t", *carryover.lag_columns("spend", 3)).orderBy("t").collect()
    assert [[r[f"lag_{i}"] for r in rows] for i in range(3)] == [[1, 2, 3, 4], [0, 1, 2, 3], [0, 0, 1, 2]]


def test_draw_adstock_identity_and_weights(spark):
    dense = panel.densify(series(spark, [("a", [4, 1, 7, 2])]).drop("t"))
    packed = panel.pack_series(dense)
    draws = spark.createDataFrame(
        [("p", 0, 0, "a", 0.0, 1.0, 1.0), ("p", 0, 1, "a", 0.5, 1.0, 1.0)],
        "panel_id string, chain int, draw bigint, channel string, decay double, sat_k double, beta double",
    )
    rows = posterior.draw_adstock(draws, packed).orderBy("draw", "t").collect()
    assert [r["adstock"] * 7 for r in rows[:4]] == pytest.approx([4, 1, 7, 2])
    total = sum(0.5**i for i in range(8))
    assert rows[5]["adstock"] * 7 == pytest.approx((1 + 0.5 * 4) / total)
    params = values_table(spark, "channel, decay", [("a", 0.5)])
    fixed = carryover.adstock_normalized(dense, params).orderBy("t").collect()
    assert [r["adstock"] for r in fixed] == pytest.approx([r["adstock"] * 7 for r in rows[4:]])
    means = posterior.posterior_means(draws, packed).first()
    both = [(a["adstock"] + b["adstock"]) / 2 for a, b in zip(rows[:4], rows[4:])]
    assert means["stock"] == pytest.approx(both)


def test_densify_fills_gaps_before_between_and_after(spark):
    cells = spark.sql(
        f"""SELECT 'p' panel_id, channel, date_add({DAY}, 7 * w) AS week, x AS spend, x * 2 AS revenue,
        0D AS competitor FROM VALUES ('a', 0, 1D), ('a', 5, 2D), ('b', 2, 3D), ('b', 3, 4D)
        AS v(channel, w, x) UNION ALL SELECT 'q', 'a', {DAY}, 9D, 9D, 9D"""
    )
    rows = panel.densify(cells).orderBy("panel_id", "channel", "t").collect()
    assert [r["spend"] for r in rows] == [1, 0, 0, 0, 0, 2, 0, 0, 3, 4, 0, 0, 9]
    assert [r["t"] for r in rows] == [0, 1, 2, 3, 4, 5] * 2 + [0]
    assert all((r["week"] - rows[0]["week"]).days == 7 * r["t"] for r in rows)
    assert {r["n_weeks"] for r in rows} == {6, 1}
    assert panel.pack_series(panel.densify(cells)).count() == 3
