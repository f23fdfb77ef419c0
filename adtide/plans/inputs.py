"""Views over the star-schema tables that the registered queries read, with the same views as SQL.

* cells / panel: weekly ad spend, revenue and competitor sales per region (panel) and market
  segment (channel), from every order and line item;
* ad log: one row per line item, label = returned;
* scores: one row per line item with a closed-form click probability that has ties;
* draws: one posterior draw per customer, parameters in closed form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import md5_bucket
from ..operators.panel import densify, pack_series, pack_weekly

# The five segments in name order, each with the label and the carry-over,
# saturation and half-point parameters of one advertising channel.
CHANNELS = [
    ("AUTOMOBILE", "tv", 0.65, 2.5, 0.50),
    ("BUILDING", "ooh", 0.55, 2.0, 0.50),
    ("FURNITURE", "print", 0.45, 1.8, 0.40),
    ("HOUSEHOLD", "facebook", 0.20, 1.5, 0.30),
    ("MACHINERY", "search", 0.05, 1.3, 0.30),
]
CHANNEL_NAMES = [c[0] for c in CHANNELS]
CHANNEL_LABELS = {c[0]: c[1] for c in CHANNELS}

# One coefficient per design term, in revenue units.
COEFS = [
    ("AUTOMOBILE", 120000.0),
    ("BUILDING", 80000.0),
    ("FURNITURE", 60000.0),
    ("HOUSEHOLD", 90000.0),
    ("MACHINERY", 40000.0),
    ("const", 500000.0),
    ("season_0", 15000.0),
    ("season_1", -9000.0),
    ("season_2", 4000.0),
    ("season_3", 2500.0),
    ("trend", 30000.0),
    ("competitor", -20000.0),
]

# What-if scenarios as channel multipliers.
SCENARIOS = [
    ("current", [1.0, 1.0, 1.0, 1.0, 1.0]),
    ("shift_to_tv", [1.5, 0.75, 0.75, 1.0, 1.0]),
    ("cut_search", [1.1, 1.1, 1.1, 1.1, 0.6]),
    ("overspend", [1.4, 1.2, 1.0, 1.3, 1.1]),
]


def values_table(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """Literal rows as a local relation, whose exact size the optimiser sees."""
    return spark.sql(f"SELECT * FROM {values_sql(columns, rows)}")


def values_sql(columns: str, rows: list[tuple]) -> str:
    def lit(v: object) -> str:
        return f"'{v}'" if isinstance(v, str) else f"CAST({v!r} AS DOUBLE)"

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({columns})"


PARAM_ROWS = [(c, d, a, k) for c, _, d, a, k in CHANNELS]
LABEL_ROWS = [(c, lab) for c, lab, *_ in CHANNELS]
SCENARIO_ROWS = [
    (name, CHANNEL_NAMES[i], m) for name, ms in SCENARIOS for i, m in enumerate(ms)
]


def channel_params(spark: SparkSession) -> DataFrame:
    return values_table(spark, "channel, decay, alpha, k_pct", PARAM_ROWS)


def channel_labels(spark: SparkSession) -> DataFrame:
    return values_table(spark, "channel, label", LABEL_ROWS)


def coefficients(spark: SparkSession) -> DataFrame:
    return values_table(spark, "term, coef", COEFS)


def scenarios(spark: SparkSession) -> DataFrame:
    return values_table(spark, "scenario_id, channel, m", SCENARIO_ROWS)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# --------------------------------------------------------------------------- media panel


def media_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(panel_id, channel, week) sums over all orders; weeks without orders are absent.

    Line items are summed per order before they meet the orders, and orders per customer and week
    before they meet the customers, so neither a hot order nor a hot customer reaches a join with
    more rows than it has orders or weeks. Money is summed as whole cents (times whole percent), so
    the order of the partial sums does not matter.
    """
    price = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    disc = F.rint(F.col("l_discount") * 100).cast("bigint")
    per_order = (
        load(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(price * disc).alias("spend"), F.sum(price * (100 - disc)).alias("revenue"))
    )
    rival = F.when(
        F.col("o_orderpriority") == "5-LOW", F.rint(F.col("o_totalprice") * 100).cast("bigint")
    )
    per_customer = (
        load(spark, sf_dir, "orders")
        .join(per_order, "o_orderkey", "left")
        .groupBy(
            F.col("o_custkey").alias("c_custkey"),
            F.date_trunc("week", "o_orderdate").cast("date").alias("week"),
        )
        .agg(
            F.sum("spend").alias("spend"),
            F.sum("revenue").alias("revenue"),
            F.sum(rival).alias("competitor"),
        )
    )
    return (
        per_customer.join(customers(spark, sf_dir), "c_custkey")
        .groupBy("panel_id", F.col("c_mktsegment").alias("channel"), "week")
        .agg(
            *[
                (F.coalesce(F.sum(c), F.lit(0)) / unit).alias(c)
                for c, unit in (("spend", 10_000), ("revenue", 10_000), ("competitor", 100))
            ]
        )
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation").join(
        load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        load(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_mktsegment", "c_acctbal", F.col("r_name").alias("panel_id"))
    )


def media_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return densify(media_cells(spark, sf_dir))


def panel_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_series(media_panel(spark, sf_dir))


def panel_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_weekly(media_panel(spark, sf_dir))


# The SQL side states the same views in the plainest way.
SQL_CELLS = """
li AS (
  SELECT l_orderkey,
         sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))) AS spend,
         sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS revenue
  FROM lineitem GROUP BY l_orderkey),
cells AS (
  SELECT r_name AS panel_id, c_mktsegment AS channel,
         CAST(date_trunc('week', o_orderdate) AS DATE) AS week,
         coalesce(CAST(sum(spend) AS DOUBLE), 0) AS spend,
         coalesce(CAST(sum(revenue) AS DOUBLE), 0) AS revenue,
         coalesce(CAST(sum(CASE WHEN o_orderpriority = '5-LOW'
                           THEN CAST(o_totalprice AS DECIMAL(14,2)) END) AS DOUBLE), 0) AS competitor
  FROM orders LEFT JOIN li ON l_orderkey = o_orderkey
  JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
  GROUP BY ALL)"""

SQL_PANEL = (
    SQL_CELLS
    + """,
span AS (SELECT panel_id, min(week) AS w0, max(week) AS w1 FROM cells GROUP BY panel_id),
grid AS (
  SELECT panel_id, channel, w0, w1,
         CAST(unnest(generate_series(w0, w1, INTERVAL 7 DAY)) AS DATE) AS week
  FROM (SELECT DISTINCT panel_id, channel FROM cells) JOIN span USING (panel_id)),
panel AS (
  SELECT g.panel_id, g.channel, g.week, (g.week - w0) // 7 AS t, (w1 - w0) // 7 + 1 AS n_weeks,
         coalesce(spend, 0) AS spend, coalesce(revenue, 0) AS revenue,
         coalesce(competitor, 0) AS competitor
  FROM grid g LEFT JOIN cells USING (panel_id, channel, week)),
weekly AS (
  SELECT panel_id, week, t, n_weeks, sum(revenue) AS revenue, sum(competitor) AS competitor
  FROM panel GROUP BY ALL),
params AS (SELECT * FROM """
    + values_sql("channel, decay, alpha, k_pct", PARAM_ROWS)
    + """),
coefs AS (SELECT * FROM """
    + values_sql("term, coef", COEFS)
    + """),
scen AS (SELECT * FROM """
    + values_sql("scenario_id, channel, m", SCENARIO_ROWS)
    + ")"
)

# --------------------------------------------------------------------------- ad log

INT_COLS = ["int_1", "int_2", "int_3"]
CAT_COLS = ["cat_1", "cat_2", "cat_3", "cat_4"]
ROW_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def ad_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: key, label, 3 nullable integers, 4 nullable categoricals.

    Each side is pruned to the columns used; hot orders, customers or parts are left to AQE's
    skew join, which may act because every join is followed by a shuffle on another key.
    """
    buyer = (
        load(spark, sf_dir, "orders")
        .join(load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.floor("c_acctbal").alias("int_2"),
            F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("cat_3"),
        )
    )
    part = load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_brand").alias("cat_1"),
        F.col("p_type").alias("cat_2"),
    )
    return (
        load(spark, sf_dir, "lineitem")
        .join(buyer, "l_orderkey")
        .join(part, "l_partkey")
        .select(
            *ROW_KEY,
            (F.col("l_returnflag") == "R").cast("int").alias("label"),
            F.nullif(F.col("l_linenumber"), F.lit(7)).alias("int_1"),
            F.col("int_2").cast("int").alias("int_2"),
            F.col("l_quantity").cast("int").alias("int_3"),
            "cat_1",
            "cat_2",
            "cat_3",
            F.col("l_suppkey").alias("cat_4"),
        )
    )


SQL_AD_LOG = """
ad_log AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(l_returnflag = 'R' AS INTEGER) AS label,
         nullif(l_linenumber, 7) AS int_1, CAST(floor(c_acctbal) AS INTEGER) AS int_2,
         CAST(l_quantity AS INTEGER) AS int_3, p_brand AS cat_1, p_type AS cat_2,
         nullif(c_mktsegment, 'BUILDING') AS cat_3, l_suppkey AS cat_4
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey)"""


def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row key, label, score): a score on a 0.001 grid, higher on average where label = 1."""
    label = (F.col("l_returnflag") == "R").cast("int")
    raw = F.expr("(CAST(l_quantity AS BIGINT) * 37 + l_linenumber * 101 + l_partkey * 17) % 1000")
    grid = F.floor(raw * 4 / 5).cast("bigint")
    return load(spark, sf_dir, "lineitem").select(
        *ROW_KEY, label.alias("label"), ((grid + label * 150 + 20) / 1000).alias("score")
    )


SQL_SCORES = """
scores AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(l_returnflag = 'R' AS INTEGER) AS label,
         (((CAST(l_quantity AS BIGINT) * 37 + l_linenumber * 101 + l_partkey * 17) % 1000) * 4 // 5
           + CAST(l_returnflag = 'R' AS INTEGER) * 150 + 20) / 1000 AS score
  FROM lineitem)"""

SPLIT_TEXT = "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def row_bucket(buckets: int) -> F.Column:
    return md5_bucket(F.expr(SPLIT_TEXT), buckets)


def sql_bucket(text: str, buckets: int) -> str:
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT % {buckets})"


# --------------------------------------------------------------------------- posterior draws


def draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(panel_id, chain, draw, channel, decay, sat_k, beta): one draw per customer."""
    c = F.col("c_custkey")
    channels = F.array(
        *[F.struct(F.lit(n).alias("channel"), F.lit(i).alias("i")) for i, n in enumerate(CHANNEL_NAMES)]
    )
    i = F.col("ch.i")
    return (
        customers(spark, sf_dir)
        .select("panel_id", "c_custkey", F.explode(channels).alias("ch"))
        .select(
            "panel_id",
            F.pmod(c, F.lit(4)).cast("int").alias("chain"),
            F.expr("c_custkey DIV 4").alias("draw"),
            F.col("ch.channel").alias("channel"),
            ((F.pmod(c * 7 + i * 29, F.lit(90)) + 5) / 100).alias("decay"),
            ((F.pmod(c * 11 + i * 17, F.lit(140)) + 10) / 100).alias("sat_k"),
            ((F.pmod(c * 13 + i * 23, F.lit(97)) + 1) / 1000).alias("beta"),
        )
    )


def draws_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(panel_id, chain, draw, intercept, season_0..3, trend, comp, sigma)."""
    c = F.col("c_custkey")
    return customers(spark, sf_dir).select(
        "panel_id",
        F.pmod(c, F.lit(4)).cast("int").alias("chain"),
        F.expr("c_custkey DIV 4").alias("draw"),
        (F.pmod(c * 3, F.lit(101)) / 200 + 0.5).alias("intercept"),
        *[((F.pmod(c * (5 + i), F.lit(41)) - 20) / 100).alias(f"season_{i}") for i in range(4)],
        ((F.pmod(c * 19, F.lit(61)) - 30) / 100).alias("trend"),
        ((F.pmod(c * 23, F.lit(31)) - 15) / 100).alias("comp"),
        (F.pmod(c, F.lit(17)) / 100 + 0.05).alias("sigma"),
    )


SQL_DRAWS = (
    """
cust AS (
  SELECT r_name AS panel_id, c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey),
draws AS (
  SELECT panel_id, CAST(c_custkey % 4 AS INTEGER) AS chain, c_custkey // 4 AS draw, channel,
         ((c_custkey * 7 + i * 29) % 90 + 5) / 100 AS decay,
         ((c_custkey * 11 + i * 17) % 140 + 10) / 100 AS sat_k,
         ((c_custkey * 13 + i * 23) % 97 + 1) / 1000 AS beta
  FROM cust, (SELECT channel, CAST(i AS BIGINT) AS i FROM """
    + values_sql("channel, i", [(n, i) for i, n in enumerate(CHANNEL_NAMES)])
    + """)),
draws_global AS (
  SELECT panel_id, CAST(c_custkey % 4 AS INTEGER) AS chain, c_custkey // 4 AS draw,
         (c_custkey * 3 % 101) / 200 + 0.5 AS intercept,
         ((c_custkey * 5) % 41 - 20) / 100 AS season_0, ((c_custkey * 6) % 41 - 20) / 100 AS season_1,
         ((c_custkey * 7) % 41 - 20) / 100 AS season_2, ((c_custkey * 8) % 41 - 20) / 100 AS season_3,
         ((c_custkey * 19) % 61 - 30) / 100 AS trend, ((c_custkey * 23) % 31 - 15) / 100 AS comp,
         (c_custkey % 17) / 100 + 0.05 AS sigma
  FROM cust)"""
)

SQL_SERIES = """,
lags AS (
  SELECT panel_id, channel, t, n_weeks, revenue, spend,
         spend / greatest(max(spend) OVER (PARTITION BY panel_id, channel), 1) AS x
  FROM panel),
lagged AS (
  SELECT a.panel_id, a.channel, a.t, b.t AS s, a.t - b.t AS l, b.x
  FROM lags a JOIN lags b ON a.panel_id = b.panel_id AND a.channel = b.channel
   AND b.t BETWEEN a.t - 7 AND a.t),
scale AS (SELECT panel_id, avg(revenue) AS revenue_mean FROM weekly GROUP BY panel_id),
totals AS (SELECT panel_id, channel, sum(spend) AS spend_total FROM panel GROUP BY ALL)"""

SQL_LAG_ARRAYS = (
    ",\nlagrow AS (SELECT panel_id, channel, t, "
    + ", ".join(f"coalesce(sum(x) FILTER (l = {i}), 0) AS x{i}" for i in range(8))
    + " FROM lagged GROUP BY ALL),\nnorm AS (SELECT *, "
    + " + ".join(f"pow(decay, {i})" for i in range(8))
    + " AS wsum FROM draws),\ndraw_adstock AS (SELECT n.*, t, ("
    + " + ".join(f"pow(decay, {i}) * x{i}" for i in range(8))
    + ") / wsum AS adstock FROM norm n JOIN lagrow USING (panel_id, channel))"
)
