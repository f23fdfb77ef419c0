"""Exact ordered aggregates against brute force, with hot keys, ties and outliers."""

import numpy as np
import pandas as pd
import pytest
from plan_text import planned

from adtide.operators import ordered


@pytest.fixture(scope="module")
def skewed():
    rng = np.random.default_rng(7)
    hot = pd.DataFrame({"k": "hot", "v": rng.lognormal(0, 3, 40_000)})
    ties = pd.DataFrame({"k": "ties", "v": np.repeat([1.0, 2.0, 2.0, 5.0], 2500)})
    small = pd.DataFrame({"k": [f"s{i}" for i in range(50)], "v": rng.normal(size=50)})
    mid = pd.concat([pd.DataFrame({"k": f"m{n}", "v": rng.normal(size=n)}) for n in (5, 30, 199, 201, 700, 799, 900, 5000, 20_000)])
    pair = pd.DataFrame({"k": "pair", "v": [0.0, 1.0]})
    peak = pd.DataFrame({"k": "peak", "v": np.r_[np.full(9000, 3.0), rng.normal(3, 1e-6, 1000)]})
    return pd.concat([hot, ties, small, mid, pair, peak], ignore_index=True)


@pytest.mark.parametrize("bound", [2, 100, 3000, 100_000])
def test_quantiles_are_exact(spark, skewed, bound):
    df = spark.createDataFrame(skewed).withColumn("one", ordered.F.lit(1)).repartition(6)
    probs = {"lo": 0.05, "mid": 0.5, "hi": 0.95, "top": 1.0, "bottom": 0.0}
    got = ordered.exact_quantiles(df, ["k"], "v", probs, totals=["one"], bound=bound).toPandas()
    got = got.set_index("k")
    for key, part in skewed.groupby("k")["v"]:
        want = np.percentile(part, [5, 50, 95, 100, 0])
        assert got.loc[key, list(probs)].tolist() == pytest.approx(want.tolist(), rel=1e-12)
        assert got.loc[key, "n"] == got.loc[key, "one"] == len(part)
        assert got.loc[key, "mean"] == pytest.approx(part.mean())
    assert len(got) == skewed["k"].nunique()


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, skewed, descending):
    df = spark.createDataFrame(skewed).withColumn("n", ordered.F.lit(1)).repartition(6)
    got = ordered.running_totals(df, ["k"], "v", ["n"], 16, descending).toPandas()
    want = skewed.groupby(["k", "v"]).size().rename("n").reset_index()
    want = want.sort_values(["k", "v"], ascending=[True, not descending])
    want["cum"] = want.groupby("k")["n"].cumsum()
    both = got.merge(want, on=["k", "v"], suffixes=("", "_w"))
    assert len(both) == len(got) == len(want)
    assert (both["n_cum"] == both["cum"]).all()
    assert (both["n_total"] == both.groupby("k")["n"].transform("sum")).all()


def test_running_totals_without_keys(spark, skewed):
    df = spark.createDataFrame(skewed).withColumn("n", ordered.F.lit(1))
    got = ordered.running_totals(df, [], "v", ["n"]).toPandas().sort_values("v")
    assert (got["n_cum"].to_numpy() == got["n"].cumsum().to_numpy()).all()
    assert set(got["n_total"]) == {len(skewed)}


def test_histogram(spark, skewed):
    df = spark.createDataFrame(skewed.reset_index())
    got = ordered.equal_width_histogram(df, ["k"], "v", 40, ["index"]).toPandas()
    for key, part in skewed.groupby("k")["v"]:
        rows = got[got["k"] == key].set_index("bin")
        assert rows["n"].sum() == len(part)
        if part.nunique() == 1:
            continue
        counts, edges = np.histogram(part, bins=40)
        mine = rows["n"].reindex(range(40), fill_value=0).to_numpy()
        assert np.abs(mine - counts).sum() <= 2  # a value on an edge may round either way
        area = (rows["density"] * (edges[1] - edges[0])).sum()
        assert area == pytest.approx(1)


def test_skew_join_matches_plain_join(spark, skewed):
    df = spark.createDataFrame(skewed)
    small = df.select("k").distinct().withColumn("x", ordered.F.length("k"))
    got = ordered.skew_join(df, small, ["k"], ["v"])
    assert got.count() == len(skewed)
    assert got.where("x != length(k)").count() == 0
    some = ordered.skew_join(df, small.where("k != 'hot'"), ["k"], ["v"], "left")
    assert some.count() == len(skewed) and some.where("x is null").count() == 40_000


@pytest.fixture
def wide_session(spark):
    """2,000 shuffle partitions, in which every key of a small table is hot."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", old)


def _even(spark, keys):
    rows = spark.range(keys * 100).select((ordered.F.col("id") % keys).alias("k"), ordered.F.col("id").alias("v"))
    small = spark.range(keys).select(ordered.F.col("id").alias("k"), ordered.F.sequence(ordered.F.lit(0), ordered.F.lit(259)).alias("xs"))
    return rows, small


def test_no_copies_without_a_hot_key(spark):
    """Even keys: the plain join, nothing is exploded, salted or hinted."""
    rows, small = _even(spark, 64)
    plan = planned(ordered.skew_join(rows, small, ["k"], ["v"]))
    assert "_salt" not in plan and "Generate" not in plan


def test_copies_at_2000_partitions(wide_session):
    """64 keys, each hot: two copies for a partition at most, and the planner knows their size."""
    rows, small = _even(wide_session, 64)
    joined = ordered.skew_join(rows, small, ["k"], ["v"])
    scans = [p for p in joined.inputFiles() if "copies" in p]
    copies = wide_session.read.parquet(*scans)
    assert 2000 <= copies.count() <= 2 * 2000 + 64
    size = int(str(copies._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert size < 10_000_000 and "BroadcastHashJoin" in planned(joined)  # 4,000 rows of 260 numbers, compressed
    old = wide_session.conf.get("spark.sql.autoBroadcastJoinThreshold")
    wide_session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = planned(ordered.skew_join(rows, small, ["k"], ["v"]))
    finally:
        wide_session.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert text.count("SortMergeJoin") == 1  # the list of hot keys is hinted, the copies are not


def test_a_hot_key_is_dealt_and_others_are_not(spark):
    rows = spark.range(10_000).select(ordered.F.when(ordered.F.col("id") < 6000, -1).otherwise(ordered.F.col("id")).alias("k"), "id")
    small = rows.select("k").distinct().withColumn("x", ordered.F.col("k") * 2)
    counts = rows.groupBy("k").agg(ordered.F.count("*").alias("_rows"))
    assert [(r["k"], r["_copies"]) for r in ordered.hot_keys(counts, ["k"], 8)] == [(-1, 5)]
    joined = ordered.skew_join(rows, small, ["k"], ["id"], counts=counts)
    copies = spark.read.parquet(*[p for p in joined.inputFiles() if "copies" in p])
    assert copies.where("k = -1").count() == 5 and copies.count() == 4001 + 4
    assert joined.count() == 10_000 and joined.where("x != 2 * k").count() == 0


def test_a_group_of_many_rows_is_never_ordered_whole(spark):
    """20 million rows, half of them equal: exact ranks from windows of at most the bound."""
    n, bound = 20_000_000, 50_000
    mixed = ordered.F.pmod(ordered.F.col("id") * 7_368_787, ordered.F.lit(n)).cast("double")
    value = ordered.F.when(mixed.between(n / 4, 3 * n / 4 - 1), n / 2).otherwise(mixed)
    df = spark.range(n).select(ordered.F.lit("one").alias("k"), value.alias("v"))
    seen = {}
    got = ordered.exact_quantiles(df, ["k"], "v", {"lo": 0.05, "mid": 0.5, "edge": 0.25, "hi": 0.95}, bound=bound)
    plan = got._jdf.queryExecution().optimizedPlan()
    stack = [plan]
    while stack:  # rows that enter the window
        node = stack.pop()
        if node.nodeName() == "Window":
            child = type(got)(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, node.child()), spark)
            seen["rows"] = child.groupBy("_of").count().agg({"count": "max"}).first()[0]
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    assert 0 < seen["rows"] <= bound + 2
    row = got.first()
    assert row["n"] == n and row["mid"] == n / 2
    for name, p in (("lo", 0.05), ("hi", 0.95)):
        assert row[name] == pytest.approx(p * (n - 1), rel=1e-12)
    assert row["edge"] == pytest.approx(n / 4 - 1 + (0.25 * (n - 1) - (n // 4 - 1)) * (n / 4 + 1), rel=1e-12)
