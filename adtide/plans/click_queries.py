"""Queries on the ad log, the event log and scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clicks, metrics
from ..sources import read_partitioned, scratch_path, spread_rows, stage, write_parquet
from . import inputs as src
from .inputs import CAT_COLS, INT_COLS, ROW_KEY, SPLIT_TEXT, SQL_AD_LOG, SQL_SCORES, sql_bucket
from .registry import query, rounded

LOG = "WITH " + SQL_AD_LOG + "\n"
SCORED = "WITH " + SQL_SCORES + "\n"
KEYS = ", ".join(ROW_KEY)
SPLIT_SQL = f"CASE WHEN {sql_bucket(SPLIT_TEXT, 100)} < 80 THEN 'train' ELSE 'test' END"


# ------------------------------------------------------------------ sources and profiling


@query(
    """SELECT ts::DATE AS day, event_type, count(*) AS n_rows,
    CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total FROM events GROUP BY ALL"""
)
def scan_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stored as day folders, found again by partition discovery."""
    events = src.load(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    root = scratch_path(spark, "events")
    write_parquet(events, root, ["day"])
    return (
        read_partitioned(spark, root)
        .groupBy("day", "event_type")
        .agg(
            F.count("*").alias("n_rows"),
            F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("total"),
        )
    )


@query(
    LOG
    + f"""SELECT {SPLIT_SQL} AS split, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS clicks,
    round(sum(ln(1 + greatest(coalesce(int_1, 0), 0))), 4) AS int_1_sum
    FROM ad_log GROUP BY ALL"""
)
def roundtrip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean features split into train and test folders, then read back."""
    clean = clicks.clean_features(src.ad_log(spark, sf_dir), INT_COLS, CAT_COLS, keep=ROW_KEY)
    split = clicks.with_split(clean, src.row_bucket(100))
    stored = write_parquet(split, scratch_path(spark, "split"), ["split"])
    return stored.groupBy("split").agg(
        F.count("*").alias("n_rows"),
        F.sum("label").alias("clicks"),
        F.round(F.sum("int_1"), 4).alias("int_1_sum"),
    )


@query(
    """SELECT source, count(*) AS n_rows, round(avg(label), 9) AS ctr,
    round(1 - avg(label), 9) AS trivial_accuracy
    FROM (SELECT 'lineitem' AS source, CAST(l_returnflag = 'R' AS INTEGER) AS label FROM lineitem
          UNION ALL SELECT 'events', CAST(event_type = 'click' AS INTEGER) FROM events) GROUP BY source"""
)
def ctr_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = src.load(spark, sf_dir, "lineitem").select(
        F.lit("lineitem").alias("source"), (F.col("l_returnflag") == "R").cast("int").alias("label")
    )
    events = src.load(spark, sf_dir, "events").select(
        F.lit("events").alias("source"), (F.col("event_type") == "click").cast("int").alias("label")
    )
    return clicks.click_rate(items.unionByName(events), ["source"]).select(
        "source", "n_rows", *rounded(9, "ctr", "trivial_accuracy")
    )


_ALL = [*INT_COLS, *CAT_COLS]


@query(
    LOG
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing,"
        f" round((count(*) - count({c})) * 100 / count(*), 9) AS pct_missing FROM ad_log"
        for c in _ALL
    )
)
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks.null_profile(src.ad_log(spark, sf_dir), _ALL).select(
        "column_name", "n_missing", *rounded(9, "pct_missing")
    )


@query(
    LOG
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, true AS sketch_ok FROM ad_log"
        for c in CAT_COLS
    )
)
def cardinality_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct counts, and whether the sketch is within three standard errors of them."""
    rsd = 0.05
    log = src.ad_log(spark, sf_dir).select(*CAT_COLS)
    exact = clicks.exact_cardinality(log, CAT_COLS)
    sketch = clicks.approx_cardinality(log, CAT_COLS, rsd)
    close = F.abs(F.col("approx_distinct") - F.col("n_distinct")) <= 3 * rsd * F.col("n_distinct")
    return exact.join(sketch, "column_name").select(
        "column_name", "n_distinct", close.alias("sketch_ok")
    )


# ------------------------------------------------------------------ features

_INTS = ", ".join(f"ln(1 + greatest(coalesce({c}, 0), 0)) AS {c}" for c in INT_COLS)
_CATS = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '__NA__') AS {c}" for c in CAT_COLS)
_CLEAN = LOG.rstrip() + f",\nclean AS (SELECT {KEYS}, label, {_INTS}, {_CATS} FROM ad_log)\n"


@query(
    _CLEAN
    + f"SELECT {KEYS}, label, "
    + ", ".join(f"round({c}, 9) AS {c}" for c in INT_COLS)
    + f", {', '.join(CAT_COLS)} FROM clean"
)
def clean_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir).select(*ROW_KEY, "label", *rounded(9, *INT_COLS), *CAT_COLS)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks.clean_features(src.ad_log(spark, sf_dir), INT_COLS, CAT_COLS, keep=ROW_KEY)


_BUCKETS = " UNION ALL ".join(
    f"SELECT {KEYS}, label, {sql_bucket(f"concat('{c}=', {c})", 65536)} AS bucket FROM clean"
    for c in CAT_COLS
)


@query(
    _CLEAN
    + f"""SELECT bucket, CAST(count(*) AS DOUBLE) AS value_sum, CAST(sum(label) AS BIGINT) AS clicks
    FROM ({_BUCKETS}) GROUP BY bucket"""
)
def hash_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and clicks of every hash bucket; the hashed rows merge per bucket before the shuffle."""
    hashed = clicks.hash_buckets(_clean(spark, sf_dir), [*ROW_KEY, "label"], CAT_COLS)
    return hashed.groupBy("bucket").agg(
        F.sum("value").alias("value_sum"), F.sum(F.col("label") * F.col("value")).cast("bigint").alias("clicks")
    )


def _vector_sql(ints: list[str]) -> str:
    total = " + ".join(ints) or "0::DOUBLE"
    return (
        _CLEAN + f"SELECT {KEYS}, label, {len(ints) + 65536} AS dimension, round({total}, 6) AS int_sum,"
        f" {len(CAT_COLS)}.0::DOUBLE AS hashed_sum FROM clean"
    )


@query(_vector_sql([]))
def hash_features_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed categoricals of every row as one sparse vector."""
    table = clicks.feature_table(_clean(spark, sf_dir), [], CAT_COLS, [*ROW_KEY, "label"])
    return _vector_report(table, 0)


@query(_vector_sql(INT_COLS))
def feature_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integers and hashed categoricals of every row as one sparse vector."""
    table = clicks.feature_table(_clean(spark, sf_dir), INT_COLS, CAT_COLS, [*ROW_KEY, "label"])
    return _vector_report(table, len(INT_COLS))


def _vector_report(table: DataFrame, ints: int) -> DataFrame:
    """Per row the vector's dimension, and the sums of its integer part and its hashed part, which
    is the number of categoricals whether or not two of them meet in a bucket."""
    size, positions, values = clicks.sparse_parts("features")
    pairs = F.arrays_zip(positions.alias("i"), values.alias("v"))

    def total(keep) -> Column:
        return F.aggregate(F.filter(pairs, keep), F.lit(0.0), lambda a, x: a + x["v"])

    return table.select(
        *ROW_KEY, "label", size.alias("dimension"),
        F.round(total(lambda x: x["i"] < ints), 6).alias("int_sum"), total(lambda x: x["i"] >= ints).alias("hashed_sum"),
    )


@query(LOG + f"SELECT {KEYS}, label, {SPLIT_SQL} AS split FROM ad_log")
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.ad_log(spark, sf_dir).select(*ROW_KEY, "label")
    return clicks.with_split(rows, src.row_bucket(100))


# ------------------------------------------------------------------ model and metrics


@query(LOG + f"SELECT {KEYS}, label, true AS is_probability FROM ad_log WHERE {SPLIT_SQL} = 'test'")
def ctr_model_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on the train part of the stored features, score the test part."""
    split = clicks.with_split(spread_rows(_clean(spark, sf_dir), ROW_KEY), src.row_bucket(100))
    features = clicks.feature_table(split, INT_COLS, CAT_COLS, [*ROW_KEY, "label", "split"])
    stored = write_parquet(features, scratch_path(spark, "features"), ["split"], gather=False)
    model = clicks.fit_click_model(stored.where(F.col("split") == "train"))
    scored = clicks.score_rows(model, stored.where(F.col("split") == "test"), [*ROW_KEY, "label"])
    inside = (F.col("score") > 0) & (F.col("score") < 1)
    return scored.select(*ROW_KEY, "label", inside.alias("is_probability"))


_PLANTED = f"""planted AS (
  SELECT *, CAST(int_3 + {sql_bucket(SPLIT_TEXT, 10)} > 30 AS INTEGER) AS planted, {SPLIT_SQL} AS split FROM ad_log)"""


@query(
    LOG.rstrip()
    + f""",
{_PLANTED},
rates AS (SELECT avg(planted) FILTER (split = 'train') AS train_ctr, avg(planted) FILTER (split = 'test') AS test_ctr,
  count(*) FILTER (split = 'test') AS n_test FROM planted)
SELECT unnest(['auc_roc', 'auc_pr', 'log_loss']) AS metric, n_test,
  round(unnest([0.5, test_ctr, -(test_ctr * ln(train_ctr) + (1 - test_ctr) * ln(1 - train_ctr))]), 9) AS baseline, true AS finds_signal
FROM rates"""
)
def trained_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split, train, score and report on labels that follow one integer and noise: every metric has
    to close more than half of the way from its baseline to a perfect score, which no constant does."""
    log = src.ad_log(spark, sf_dir).withColumn("label", (F.col("int_3") + src.row_bucket(10) > 30).cast("int"))
    clean = clicks.clean_features(log, INT_COLS, CAT_COLS, keep=ROW_KEY)
    split = clicks.with_split(spread_rows(clean, ROW_KEY), src.row_bucket(100))
    features = clicks.feature_table(split, INT_COLS, CAT_COLS, ["label", "split"])
    stored = write_parquet(features, scratch_path(spark, "features"), ["split"], gather=False)
    model = clicks.fit_click_model(stored.where(F.col("split") == "train"))
    test = stage(clicks.score_rows(model, stored.where(F.col("split") == "test"), ["label", "split"]), "scored")
    # of the train rows the report needs the labels only
    rest = stored.where(F.col("split") != "test").select("label", "split", F.lit(None).cast("double").alias("score"))
    report = metrics.metric_report(test.unionByName(rest))
    perfect = F.when(F.col("metric") == "log_loss", 0.0).otherwise(1.0)
    way = (F.col("model") - F.col("baseline")) / (perfect - F.col("baseline"))
    tested = test.agg(F.count("*").alias("n_test"))
    return report.select(
        "metric", tested.scalar().alias("n_test"), *rounded(9, "baseline"), (way > 0.5).alias("finds_signal")
    )


@query(
    LOG
    + f"""SELECT {SPLIT_SQL} AS split, count(*) AS n_rows, {len(INT_COLS) + 65536} AS dimension, true AS all_stored,
    true AS has_files FROM ad_log GROUP BY ALL"""
)
def feature_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension, rows and size on disk of the stored features; at most one value a column, and no
    fewer than the categoricals when no two of them meet."""
    # tasks sort what they write by split, so rows are dealt in parts of bounded size first
    clean = _clean(spark, sf_dir).hint("rebalance", *ROW_KEY)
    split = clicks.with_split(clean, src.row_bucket(100))
    features = clicks.feature_table(split, INT_COLS, CAT_COLS, ["label", "split"])
    path = scratch_path(spark, "features")
    write_parquet(features, path, ["split"], gather=False)
    report = clicks.feature_report(spark, path)
    most = F.col("n_rows") * len(INT_COLS + CAT_COLS)
    least = F.col("n_rows") * (len(CAT_COLS) - 1)
    return report.select(
        "split", "n_rows", "dimension", F.col("n_values").between(least, most).alias("all_stored"),
        ((F.col("n_files") > 0) & (F.col("n_bytes") > 8 * F.col("n_rows"))).alias("has_files"),
    )


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, CASE any_value(typeof({c})) WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'"
        f" WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(any_value(typeof({c}))) END AS type,"
        f" count(*) AS n_rows, count(*) - count({c}) AS n_null FROM orders"
        for i, c in enumerate(_ORDER_COLS, 1)
    )
)
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, types and missing values of the columns of orders."""
    return clicks.column_profile(src.load(spark, sf_dir, "orders"))


_CONF = (
    SCORED.rstrip()
    + """,
by_score AS (
  SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM {rows} GROUP BY score),
conf AS (
  SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
         sum(pos) OVER () AS p_all, sum(neg) OVER () AS n_all
  FROM by_score WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
steps AS (
  SELECT *, tp / (tp + fp) AS prec,
         coalesce(lag(tp / (tp + fp)) OVER (ORDER BY score DESC), tp / (tp + fp)) AS prec0 FROM conf),
areas AS (
  SELECT sum(neg * (tp - pos / 2)) / (max(p_all) * max(n_all)) AS auc_roc,
         sum(pos * (prec + prec0) / 2) / max(p_all) AS auc_pr FROM steps)
"""
)
_CONF_ALL = _CONF.format(rows="scores")


@query(
    _CONF_ALL
    + """SELECT score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
    round(tp / greatest(p_all, 1), 9) AS tpr, round(fp / greatest(n_all, 1), 9) AS fpr FROM conf
    UNION ALL SELECT NULL, 0, 0, 0, 0"""
)
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    confusion = metrics.confusion_by_score(src.scored_rows(spark, sf_dir))
    return metrics.roc_curve(confusion).select("score", "tp", "fp", *rounded(9, "tpr", "fpr"))


@query(_CONF_ALL + "SELECT round(auc_roc, 9) AS auc_roc FROM areas")
def auc_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    confusion = metrics.confusion_by_score(src.scored_rows(spark, sf_dir))
    return metrics.auc_roc(confusion).select(*rounded(9, "auc_roc"))


@query(_CONF_ALL + "SELECT round(auc_pr, 9) AS auc_pr FROM areas")
def auc_pr(spark: SparkSession, sf_dir: str) -> DataFrame:
    confusion = metrics.confusion_by_score(src.scored_rows(spark, sf_dir))
    return metrics.auc_pr(confusion).select(*rounded(9, "auc_pr"))


_LOSS = "-(label * ln(score) + (1 - label) * ln(1 - score))"


@query(SCORED + f"SELECT round(avg({_LOSS}), 9) AS log_loss FROM scores")
def log_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.log_loss(src.scored_rows(spark, sf_dir)).select(*rounded(9, "log_loss"))


_RATES = (
    "rates AS (SELECT avg(label) FILTER (split = 'train') AS train_ctr,"
    " avg(label) FILTER (split = 'test') AS test_ctr FROM parts),\n"
    "base AS (SELECT *, -(test_ctr * ln(train_ctr) + (1 - test_ctr) * ln(1 - train_ctr)) AS base_loss"
    " FROM rates)"
)
_PARTS = f"parts AS (SELECT *, {SPLIT_SQL} AS split FROM scores)"


@query(
    SCORED.rstrip()
    + f",\n{_PARTS},\n{_RATES}\n"
    + """SELECT round(train_ctr, 9) AS train_ctr, round(test_ctr, 9) AS test_ctr,
    round(base_loss, 9) AS baseline_log_loss FROM base"""
)
def baseline_log_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = clicks.with_split(src.scored_rows(spark, sf_dir), src.row_bucket(100))
    return metrics.baseline_log_loss(split).select(
        *rounded(9, "train_ctr", "test_ctr", "baseline_log_loss")
    )


@query(
    (SCORED.rstrip() + f",\n{_PARTS},\ntest AS (SELECT * FROM parts WHERE split = 'test')")
    + _CONF.format(rows="test")[len(SCORED.rstrip()) :].rstrip()
    + f",\n{_RATES},\nloss AS (SELECT avg({_LOSS}) AS model_loss FROM test)\n"
    + """SELECT metric, round(model, 9) AS model, round(baseline, 9) AS baseline,
    round(CASE WHEN metric = 'log_loss' THEN (baseline - model) ELSE model - baseline END / baseline * 100, 7)
      AS lift_pct
    FROM (SELECT 'auc_roc' AS metric, auc_roc AS model, 0.5 AS baseline FROM areas
          UNION ALL SELECT 'auc_pr', auc_pr, test_ctr FROM areas, base
          UNION ALL SELECT 'log_loss', model_loss, base_loss FROM loss, base)"""
)
def metric_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = clicks.with_split(src.scored_rows(spark, sf_dir), src.row_bucket(100))
    return metrics.metric_report(split).select(
        "metric", *rounded(9, "model", "baseline"), *rounded(7, "lift_pct")
    )
