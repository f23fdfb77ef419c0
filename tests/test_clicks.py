import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from adtide.operators import clicks
from adtide.plans.jobs import click_job
from adtide.sources import read_parts, read_partitioned, write_csv, write_parquet

SCHEMA = "clicked int, visits int, pages int, age int, site string, device bigint"
INTS = ["visits", "pages", "age"]
CATS = ["site", "device"]


def test_clean_values(spark):
    raw = spark.createDataFrame(
        [(0, 99, -1, None, None, 7), (1, 0, 1, -40, "news", None), (None, None, 6, 2, "", 0)], SCHEMA
    )
    got = {r["clicked"]: r for r in clicks.clean_features(raw, INTS, CATS, "clicked").collect()}
    assert got[0][1:] == (pytest.approx(math.log(100)), 0, 0, "__NA__", "7")
    assert got[1][1:] == (0, pytest.approx(math.log(2)), 0, "news", "__NA__")
    assert got[None][1:] == (0, pytest.approx(math.log(7)), pytest.approx(math.log(3)), "", "0")


def test_clean_leaves_no_nulls(spark):
    raw = spark.createDataFrame([(0, None, None, None, None, None), (1, 12, -3, 5, "blog", 2)], SCHEMA)
    clean = clicks.clean_features(raw, INTS, CATS, "clicked")
    profile = clicks.null_profile(clean, INTS + CATS).collect()
    assert {r["n_missing"] for r in profile} == {0}
    assert {r["n_missing"] for r in clicks.null_profile(raw, INTS).collect()} == {1}


def test_buckets_keep_weight_under_collisions(spark):
    raw = spark.range(500).select(
        "id", F.lit(1).alias("label"), *[(F.col("id") % (3 + i)).cast("string").alias(f"c{i}") for i in range(6)]
    )
    rows = clicks.hash_buckets(raw, ["id"], [f"c{i}" for i in range(6)], buckets=16).cache()
    assert rows.groupBy("id").agg(F.sum("value").alias("s")).where("s != 6").count() == 0
    assert rows.where("value > 1").count() > 0
    assert rows.groupBy("id", "bucket").count().where("count > 1").count() == 0


def test_feature_vector_layout(spark):
    raw = spark.createDataFrame([(1, None, 3, 0, "shop", None)], SCHEMA)
    clean = clicks.clean_features(raw, INTS, CATS, "clicked")
    vec = clicks.feature_table(clean, INTS, CATS, ["clicked"]).first()["features"]
    assert vec.size == 3 + 2**16
    assert vec[1] == pytest.approx(math.log(4)) and sum(vec.toArray()[3:]) == 2


def test_partition_discovery_first_parts_and_sinks(spark, tmp_path):
    root = str(tmp_path / "log")
    days = spark.range(4000).select(
        "id", F.expr("date_add(date'2015-02-15', cast(id % 3 as int))").alias("day")
    )
    days.repartition(5).write.partitionBy("day").parquet(root)
    got = read_partitioned(spark, root)
    one = got.where("day = date'2015-02-16'")
    assert one.count() == 1333
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2015-02-16" in plan
    some = read_parts(spark, root, "2015-02-16", 2)
    assert len(some.inputFiles()) == 2 and some.select("day").distinct().count() == 1
    all_parts = sorted(f for f in got.inputFiles() if "/day=2015-02-16/" in f)
    assert sorted(some.inputFiles()) == all_parts[:2] and len(all_parts) == 5
    assert read_parts(spark, root, "2015-02-16").count() == 1333
    with pytest.raises(AnalysisException):
        read_parts(spark, root, "2015-03-01")
    stored = write_parquet(got, str(tmp_path / "copy"), ["day"])
    assert stored.count() == 4000
    write_csv(one, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 1333


def test_split_ignores_layout(spark):
    df = spark.range(20_000)
    bucket = clicks.md5_bucket(F.col("id").cast("string"), 100)
    one = {r["id"] for r in clicks.with_split(df, bucket).where("split = 'train'").collect()}
    two = {r["id"] for r in clicks.with_split(df.repartition(7), bucket).where("split = 'train'").collect()}
    assert one == two and 0.78 < len(one) / 20_000 < 0.82


def test_click_job_learns_planted_signal(spark, tmp_path):
    log = spark.range(6000).select(
        "id",
        ((F.col("id") % 4 == 0) != (F.abs(F.hash("id")) % 10 == 0)).cast("int").alias("label"),
        (F.col("id") % 7).cast("int").alias("i1"),
        F.concat(F.lit("c"), F.col("id") % 4).alias("c1"),
    )
    out = click_job(log, ["id"], ["i1"], ["c1"], str(tmp_path))
    report = {r["metric"]: r for r in out["metrics"].collect()}
    assert report["auc_roc"]["model"] > 0.8 and report["log_loss"]["lift_pct"] > 10
    again = clicks.score_rows(
        clicks.load_model(str(tmp_path / "model")), spark.read.parquet(str(tmp_path / "features")), ["id"]
    )
    both = again.join(out["scored"].withColumnRenamed("score", "old"), "id")
    assert both.count() == 6000 and both.where("abs(score - old) > 1e-12").count() == 0
    assert out["roc"].where("score is null").count() == 1


def murmur3(data: bytes, seed: int = 42) -> int:
    """MurmurHash3 of 32 bits, as a signed number."""
    mask, h = 0xFFFFFFFF, seed
    rotate = lambda x, r: (x << r | x >> 32 - r) & mask
    mix = lambda k: rotate(k * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
    whole = len(data) // 4 * 4
    for i in range(0, whole, 4):
        h = (rotate(h ^ mix(int.from_bytes(data[i : i + 4], "little")), 13) * 5 + 0xE6546B64) & mask
    h ^= mix(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def test_vectors_hold_the_right_buckets(spark):
    """Every position and value of the vector, from the text of each column."""
    rows = [(1, 5.0, "a", "x"), (0, 0.0, "__NA__", "é"), (1, 2.5, "a", "a")]
    df = spark.createDataFrame(rows, "label int, i double, c string, d string")
    table = clicks.feature_table(df, ["i"], ["c", "d"], ["label"])
    size, positions, values = clicks.sparse_parts("features")
    got = table.select(size.alias("n"), positions.alias("at"), values.alias("v")).collect()
    for (_, i, c, d), r in zip(rows, got):
        want = {0: i} if i else {}
        for text in (f"c={c}", f"d={d}"):
            at = 1 + murmur3(text.encode()) % 65536
            want[at] = want.get(at, 0.0) + 1.0
        assert (r["n"], dict(zip(r["at"], r["v"]))) == (65537, want)


def test_column_profile(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", None)], "`a.b` int, c string, n array<int>")
    got = [tuple(r) for r in clicks.column_profile(df).orderBy("position").collect()]
    assert got == [(1, "a.b", "int", 2, 0), (2, "c", "string", 2, 1), (3, "n", "array<int>", 2, 2)]


def test_feature_report(spark, tmp_path):
    df = spark.createDataFrame([(i % 2, float(i), f"c{i}", "s" if i < 7 else "t") for i in range(10)], "label int, i double, c string, split string")
    table = clicks.feature_table(df, ["i"], ["c"], ["label", "split"])
    path = str(tmp_path / "features")
    table.write.partitionBy("split").parquet(path)
    got = {r["split"]: r for r in clicks.feature_report(spark, path).collect()}
    assert {s: (r["n_rows"], r["dimension"], r["n_values"]) for s, r in got.items()} == {"s": (7, 65537, 13), "t": (3, 65537, 6)}
    for s, r in got.items():
        files = list((tmp_path / "features" / f"split={s}").glob("*.parquet"))
        assert (r["n_files"], r["n_bytes"]) == (len(files), sum(f.stat().st_size for f in files))


def _small_star(spark, folder):
    n = 300
    spark.range(n).selectExpr(
        "id AS l_orderkey", "id % 20 AS l_partkey", "id % 5 AS l_suppkey", "CAST(id % 9 AS INT) AS l_linenumber",
        "CAST(id % 50 AS DOUBLE) AS l_quantity", "IF(id % 3 = 0, 'R', 'N') AS l_returnflag",
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(n).selectExpr("id AS o_orderkey", "id % 40 AS o_custkey").write.parquet(f"{folder}/orders.parquet")
    spark.range(40).selectExpr("id AS c_custkey", "id * 1.5D AS c_acctbal", "IF(id % 2 = 0, 'A', 'BUILDING') AS c_mktsegment").write.parquet(f"{folder}/customer.parquet")
    spark.range(20).selectExpr("id AS p_partkey", "concat('b', id % 3) AS p_brand", "concat('t', id % 4) AS p_type").write.parquet(f"{folder}/part.parquet")


def test_only_test_rows_are_scored_for_the_report(spark, tmp_path, monkeypatch):
    from adtide.plans import click_queries as queries

    _small_star(spark, tmp_path)
    seen, score = [], queries.clicks.score_rows
    monkeypatch.setattr(queries.clicks, "score_rows", lambda model, rows, keep: seen.append(rows) or score(model, rows, keep))
    out = {r["metric"]: r["n_test"] for r in queries.trained_report(spark, str(tmp_path)).collect()}
    assert {r["split"] for r in seen[0].select("split").distinct().collect()} == {"test"}
    assert set(out.values()) == {seen[0].count()} and len(out) == 3


def test_stored_features_are_written_in_bounded_parts(spark, tmp_path, monkeypatch):
    from adtide.plans import click_queries as queries

    _small_star(spark, tmp_path)
    seen, write = [], queries.write_parquet
    monkeypatch.setattr(queries, "write_parquet", lambda df, *a, **k: seen.append(df) or write(df, *a, **k))
    report = queries.feature_report(spark, str(tmp_path)).collect()
    assert sum(r["n_rows"] for r in report) == 300
    assert "REBALANCE_PARTITIONS_BY_COL" in seen[0]._jdf.queryExecution().executedPlan().toString()
