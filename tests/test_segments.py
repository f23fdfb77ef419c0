"""Scans along series in segments, against plain loops, and one very long series."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from adtide.operators import regression, segments


def rows_of(spark, lengths, seed=1):
    rng = random.Random(seed)
    rows = [(k, d, t, rng.uniform(-5, 5) if rng.random() < 0.6 else 0.0, f"r{t}") for k, (n, d) in lengths.items() for t in range(n)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, decay double, t bigint, x double, note string").repartition(5)


@pytest.mark.parametrize("size,fan", [(1, 2), (7, 2), (7, 3), (64, 1024), (4096, 1024)])
def test_segmented_sum_matches_a_loop(spark, monkeypatch, size, fan):
    """Several levels of maps, series of one step, of exactly a segment and of one more; decay 0, 1 and over 1."""
    monkeypatch.setattr(segments, "FAN", fan)
    rows, df = rows_of(spark, {"one": (1, 0.5), "seg": (7, 0.9), "more": (8, 0.9), "long": (100, 0.97), "zero": (20, 0.0), "sum": (30, 1.0), "grow": (40, 1.2)})
    got = segments.segmented_sum(df, ["k"], "t", "x", "decay", "y", size)
    assert got.columns == [*df.columns, "y"]
    got = {(r["k"], r["t"]): r for r in got.collect()}
    assert len(got) == len(rows)
    before = {}
    for k, d, t, x, note in sorted(rows, key=lambda r: (r[0], r[2])):
        before[k] = x + d * before.get(k, 0.0)
        assert got[k, t]["y"] == pytest.approx(before[k], rel=1e-11, abs=1e-11)
        assert (got[k, t]["x"], got[k, t]["note"]) == (x, note)


@pytest.mark.parametrize("size", [1, 3, 50, 4096])
def test_segmented_lag_matches_the_window(spark, size):
    _, df = rows_of(spark, {"one": (1, 0.5), "a": (50, 0.5), "b": (51, 0.5), "c": (151, 0.5)})
    df = df.withColumn("x", F.when(F.col("x") != 0, F.col("x")))  # nulls are values too
    want = df.withColumn("p", F.lag("x").over(Window.partitionBy("k").orderBy("t")))
    got = segments.segmented_lag(df, ["k"], "t", "x", "p", size).select(*want.columns)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_fit_statistics_do_not_depend_on_segments(spark):
    rng = random.Random(3)
    rows = [(p, t, rng.uniform(0, 9), rng.gauss(0, 1)) for p in ("p", "q") for t in range(300)]
    df = spark.createDataFrame(rows, "panel_id string, t bigint, actual double, residual double")
    whole = {r["panel_id"]: r.asDict() for r in regression.fit_stats(df, 4).collect()}
    for size in (1, 16, 299):
        for r in regression.fit_stats(df, 4, size).collect():
            assert r.asDict() == pytest.approx(whole[r["panel_id"]])
    for p in ("p", "q"):
        e = [r[3] for r in sorted(rows) if r[0] == p]
        steps = sum((a - b) ** 2 for a, b in zip(e[1:], e))
        assert whole[p]["durbin_watson"] == pytest.approx(steps / sum(x * x for x in e))


def test_one_long_series_is_spread_over_tasks(spark):
    """Ten million steps: the recursion holds at every step, and no task works on more than its share."""
    n = 10_000_000
    x = (F.pmod(F.xxhash64("t"), F.lit(1000)) / 100.0).alias("x")
    df = spark.range(n).select(F.lit("s").alias("k"), F.col("id").alias("t"), F.lit(0.999).alias("decay")).select("*", x)
    got = segments.segmented_sum(df, ["k"], "t", "x", "decay", "y").select("k", "t", "x", "y", F.spark_partition_id().alias("part"))
    again = segments.segmented_lag(got, ["k"], "t", "y", "p")
    gap = F.abs(F.col("y") - F.col("x") - 0.999 * F.coalesce("p", F.lit(0.0)))
    row = again.agg(F.max(gap).alias("gap"), F.count("*").alias("n"), F.count_if(F.col("p").isNull()).alias("starts")).first()
    assert row["n"] == n and row["starts"] == 1 and row["gap"] < 1e-8
    parts = [r["count"] for r in got.groupBy("part").count().collect()]
    assert len(parts) > 4 and max(parts) < n / 3
