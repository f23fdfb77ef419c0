"""Queries on the weekly media panel: sources, shapes, scaling, carry-over, regression."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clip, exponential_saturation, fourier_terms, hill_saturation, safe_ratio
from ..operators import carryover, panel, regression, segments
from ..operators.panel import panel_window, series_window
from ..sources.files import stage
from . import inputs as src
from .inputs import CHANNEL_NAMES, SQL_PANEL
from .registry import query, rounded

W = "WITH " + SQL_PANEL + "\n"
KEY = ["panel_id", "channel", "week"]


# ------------------------------------------------------------------ profile and shapes


@query(
    """SELECT count(*) AS n_rows, 6 AS n_columns, min(o_orderdate)::DATE AS first_day,
    max(o_orderdate)::DATE AS last_day FROM orders"""
)
def dataset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = src.load(spark, sf_dir, "orders")
    return orders.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(orders.columns)).alias("n_columns"),
        F.min("o_orderdate").cast("date").alias("first_day"),
        F.max("o_orderdate").cast("date").alias("last_day"),
    )


@query(
    """SELECT o_orderkey, o_orderdate::DATE AS order_day, o_totalprice FROM orders
    ORDER BY o_orderdate, o_orderkey LIMIT 3"""
)
def dataset_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        src.load(spark, sf_dir, "orders")
        .orderBy("o_orderdate", "o_orderkey")
        .select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_day"), "o_totalprice")
        .limit(3)
    )


@query(W + "SELECT panel_id, channel, week, t, n_weeks, spend, revenue, competitor FROM panel")
def dense_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.media_panel(spark, sf_dir)


_PIVOT = ", ".join(
    f"coalesce(sum(spend) FILTER (channel = '{c}'), 0) AS {c}" for c in CHANNEL_NAMES
)


@query(W + f"SELECT panel_id, week, t, {_PIVOT} FROM panel GROUP BY ALL")
def panel_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.widen(src.media_panel(spark, sf_dir), CHANNEL_NAMES)


_NAMED = ", ".join(
    f"coalesce(sum(spend) FILTER (channel = '{c}'), 0) AS {lab}"
    for c, lab in src.CHANNEL_LABELS.items()
)


@query(W + f"SELECT panel_id, week, t, {_NAMED} FROM panel GROUP BY ALL")
def channel_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = panel.widen(src.media_panel(spark, sf_dir), CHANNEL_NAMES)
    return wide.withColumnsRenamed(src.CHANNEL_LABELS)


@query(
    W
    + "SELECT panel_id, week, t, label, spend FROM panel JOIN "
    + src.values_sql("channel, label", src.LABEL_ROWS)
    + " USING (channel)"
)
def panel_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = panel.widen(src.media_panel(spark, sf_dir), CHANNEL_NAMES)
    long = panel.lengthen(wide, CHANNEL_NAMES)
    return long.join(src.channel_labels(spark), "channel").drop("channel")


# ------------------------------------------------------------------ scaling and small rules


@query(
    W
    + """SELECT panel_id, week, round(revenue, 4) AS revenue,
    round(revenue / avg(revenue) OVER (PARTITION BY panel_id), 9) AS scaled FROM weekly"""
)
def scale_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = panel.weekly_totals(src.media_panel(spark, sf_dir))
    return panel.scale_by_mean(weekly).select(
        "panel_id", "week", *rounded(4, "revenue"), *rounded(9, "scaled")
    )


@query(
    W
    + """SELECT panel_id, channel, week, round(spend / greatest(max(spend)
    OVER (PARTITION BY panel_id, channel), 1), 9) AS scaled FROM panel"""
)
def scale_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.scale_spend(src.media_panel(spark, sf_dir)).select(*KEY, *rounded(9, "scaled"))


@query(
    W
    + """SELECT panel_id, week, round(coalesce(competitor /
    nullif(max(competitor) OVER (PARTITION BY panel_id), 0), 0), 9) AS competitor_index FROM weekly"""
)
def competitor_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = panel.weekly_totals(src.media_panel(spark, sf_dir))
    return panel.competitor_index(weekly).select(
        "panel_id", "week", *rounded(9, "competitor_index")
    )


@query(W + "SELECT panel_id, week, t, round(t / n_weeks, 9) AS trend FROM weekly")
def trend_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = panel.weekly_totals(src.media_panel(spark, sf_dir))
    return weekly.select("panel_id", "week", "t", F.round(panel.trend_term(), 9).alias("trend"))


_SEASON_SQL = ", ".join(
    f"{fn}(2 * pi() * {h} * t / 52.18) AS season_{2 * (h - 1) + i}"
    for h in (1, 2)
    for i, fn in enumerate(("sin", "cos"))
)
_SEASON_ROUND = ", ".join(f"round(season_{i}, 9) AS season_{i}" for i in range(4))


@query(
    W
    + f"SELECT panel_id, week, t, {_SEASON_ROUND} FROM (SELECT *, {_SEASON_SQL} FROM weekly)",
    name="fourier_terms",
)
def season_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = panel.weekly_totals(src.media_panel(spark, sf_dir))
    return weekly.select("panel_id", "week", "t", *fourier_terms(F.col("t"))).select(
        "panel_id", "week", "t", *rounded(9, *regression.SEASON)
    )


@query(
    W
    + """SELECT panel_id, channel, week, round(least(greatest(coalesce(spend / nullif(avg(spend)
    OVER (PARTITION BY panel_id, channel), 0), 0), 0.3), 2.0), 9) AS multiplier FROM panel"""
)
def clip_multiplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = src.media_panel(spark, sf_dir)
    m = safe_ratio(F.col("spend"), F.avg("spend").over(series_window()))
    return p.select(*KEY, F.round(clip(m, 0.3, 2.0), 9).alias("multiplier"))


@query(
    W
    + """SELECT panel_id, channel, round(spend_total, 4) AS spend_total,
    round(coalesce(spend_total / nullif(sum(spend_total) OVER (PARTITION BY panel_id), 0), 0) * 100, 9)
      AS share_pct
    FROM (SELECT panel_id, channel, sum(spend) AS spend_total FROM panel GROUP BY ALL)"""
)
def budget_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.budget_share(src.media_panel(spark, sf_dir)).select(
        "panel_id", "channel", *rounded(4, "spend_total"), *rounded(9, "share_pct")
    )


@query(
    W
    + """SELECT panel_id, round(sum(spend), 4) AS spend, round(sum(revenue), 4) AS revenue,
    round(sum(revenue) / nullif(sum(spend), 0), 9) AS ratio FROM panel GROUP BY panel_id"""
)
def revenue_spend_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        src.media_panel(spark, sf_dir)
        .groupBy("panel_id")
        .agg(F.sum("spend").alias("spend"), F.sum("revenue").alias("revenue"))
        .withColumn("ratio", F.try_divide("revenue", "spend"))
        .select("panel_id", *rounded(4, "spend", "revenue"), *rounded(9, "ratio"))
    )


# ------------------------------------------------------------------ carry-over and saturation


@query(W + "SELECT panel_id, channel, week, spend, decay, alpha, k_pct FROM panel JOIN params USING (channel)")
def join_channel_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = src.media_panel(spark, sf_dir).select(*KEY, "spend")
    return p.join(src.channel_params(spark), "channel")


_STOCK = (
    W.rstrip()
    + """,
stock AS (
  SELECT a.panel_id, a.channel, a.week, a.t, decay, alpha, k_pct,
         sum(b.spend * pow(decay, a.t - b.t)) AS adstock
  FROM panel a JOIN panel b ON a.panel_id = b.panel_id AND a.channel = b.channel AND b.t <= a.t
  JOIN params ON params.channel = a.channel GROUP BY ALL),
top AS (
  SELECT *, greatest(max(adstock) OVER (PARTITION BY panel_id, channel), 1) AS top FROM stock)
"""
)


@query(_STOCK + "SELECT panel_id, channel, week, round(adstock / top, 8) AS adstock_share FROM top")
def adstock_segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same carry-over with every series cut into segments of 16 weeks, as long series are."""
    rows = src.media_panel(spark, sf_dir).select(*KEY, "t", "spend").join(src.channel_params(spark).select("channel", "decay"), "channel")
    stocked = segments.segmented_sum(rows, ["panel_id", "channel"], "t", "spend", "decay", "adstock", 16)
    top = F.greatest(F.max("adstock").over(series_window()), F.lit(1.0))
    return stocked.select(*KEY, F.round(F.col("adstock") / top, 8).alias("adstock_share"))


@query(_STOCK + "SELECT panel_id, channel, week, round(adstock / top, 8) AS adstock_share FROM top")
def adstock_geometric(spark: SparkSession, sf_dir: str) -> DataFrame:
    stocked = carryover.adstock_geometric(
        src.media_panel(spark, sf_dir), src.channel_params(spark), keep=["week", "spend"]
    )
    top = F.greatest(F.max("adstock").over(series_window()), F.lit(1.0))
    return stocked.select(*KEY, F.round(F.col("adstock") / top, 8).alias("adstock_share"))


_LAGS = ", ".join(
    f"lag(spend, {i}, 0) OVER (PARTITION BY panel_id, channel ORDER BY t) AS lag_{i}"
    for i in range(8)
)


@query(W + f"SELECT panel_id, channel, t, {_LAGS} FROM panel")
def lag_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = src.media_panel(spark, sf_dir)
    return p.select("panel_id", "channel", "t", *carryover.lag_columns("spend"))


_WSUM = " + ".join(f"pow(decay, {i})" for i in range(8))
_DOT = " + ".join(f"pow(decay, {i}) * lag_{i}" for i in range(8))


@query(
    W
    + f"""SELECT panel_id, channel, t, round(({_DOT}) / ({_WSUM}) /
    greatest(max(lag_0) OVER (PARTITION BY panel_id, channel), 1), 9) AS adstock_share
    FROM (SELECT panel_id, channel, t, {_LAGS} FROM panel) JOIN params USING (channel)"""
)
def adstock_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    stocked = carryover.adstock_normalized(
        src.media_panel(spark, sf_dir), src.channel_params(spark)
    )
    top = F.greatest(F.max("spend").over(series_window()), F.lit(1.0))
    return stocked.select(
        "panel_id", "channel", "t", F.round(F.col("adstock") / top, 9).alias("adstock_share")
    )


_HILL = "pow({x}, alpha) / nullif(pow({x}, alpha) + pow({k}, alpha), 0)"


@query(
    W
    + "SELECT panel_id, channel, week, round(coalesce("
    + _HILL.format(x="spend", k="(k_pct * top)")
    + """, 0), 9) AS response FROM (SELECT *, max(spend) OVER (PARTITION BY panel_id, channel) AS top
    FROM panel) JOIN params USING (channel)""",
    name="hill_saturation",
)
def hill_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = src.media_panel(spark, sf_dir).withColumn("top", F.max("spend").over(series_window()))
    y = hill_saturation(F.col("spend"), F.col("alpha"), F.col("k_pct") * F.col("top"))
    return p.join(src.channel_params(spark), "channel").select(*KEY, F.round(y, 9).alias("response"))


@query(
    W
    + """SELECT panel_id, channel, week, round(1 - exp(-x / k_pct), 9) AS response
    FROM (SELECT *, spend / greatest(max(spend) OVER (PARTITION BY panel_id, channel), 1) AS x FROM panel)
    JOIN params USING (channel)""",
    name="exponential_saturation",
)
def exponential_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = panel.scale_spend(src.media_panel(spark, sf_dir)).join(src.channel_params(spark), "channel")
    y = exponential_saturation(F.col("scaled"), F.col("k_pct"))
    return p.select(*KEY, F.round(y, 9).alias("response"))


@query(
    _STOCK
    + ", curve AS (SELECT DISTINCT panel_id, channel, alpha, k_pct, max(adstock) OVER"
    + " (PARTITION BY panel_id, channel) AS top FROM stock)"
    + " SELECT panel_id, channel, CAST(step AS INTEGER) AS step, round(coalesce("
    + _HILL.format(x="(step / 199 * top)", k="(k_pct * top)")
    + ", 0), 9) AS response FROM curve, range(200) AS r(step)"
)
def saturation_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = regression.saturation_curve(src.media_panel(spark, sf_dir), src.channel_params(spark))
    return curve.select("panel_id", "channel", "step", *rounded(9, "response"))


# ------------------------------------------------------------------ regression

_DESIGN = (
    _STOCK.rstrip()
    + """,
sat AS (
  SELECT panel_id, channel, week, t, coalesce("""
    + _HILL.format(x="adstock", k="(k_pct * k_top)")
    + """, 0) AS sat
  FROM (SELECT *, max(adstock) OVER (PARTITION BY panel_id, channel) AS k_top FROM stock)),
design AS (
  SELECT weekly.panel_id, weekly.week, t, revenue, """
    + ", ".join(
        f"(SELECT coalesce(max(sat), 0) FROM sat s WHERE s.panel_id = weekly.panel_id AND"
        f" s.week = weekly.week AND s.channel = '{c}') AS {c}"
        for c in CHANNEL_NAMES
    )
    + f""", {_SEASON_SQL}, t / n_weeks AS trend,
    coalesce(competitor / nullif(max(competitor) OVER (PARTITION BY panel_id), 0), 0) AS competitor
  FROM weekly)
"""
)
_TERMS = [*CHANNEL_NAMES, *regression.CONTROLS]


@query(
    _DESIGN
    + "SELECT panel_id, week, t, round(revenue, 4) AS revenue, "
    + ", ".join(f"round({c}, 9) AS {c}" for c in _TERMS)
    + " FROM design"
)
def mmm_design(spark: SparkSession, sf_dir: str) -> DataFrame:
    design = _design(spark, sf_dir)
    return design.select("panel_id", "week", "t", *rounded(4, "revenue"), *rounded(9, *_TERMS))


def _design(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regression.mmm_design(
        src.media_panel(spark, sf_dir), src.channel_params(spark), CHANNEL_NAMES
    )


_CONTRIB = (
    _DESIGN.rstrip()
    + """,
long AS (
  SELECT panel_id, week, t, revenue, term, x FROM design
  UNPIVOT (x FOR term IN ("""
    + ", ".join(_TERMS)
    + """))
  UNION ALL SELECT panel_id, week, t, revenue, 'const', 1 FROM design),
contrib AS (
  SELECT long.panel_id, long.week, long.t, coalesce(panel.channel, 'base') AS component,
         sum(coef * x) AS contribution, coalesce(max(panel.spend), 0) AS spend,
         max(long.revenue) AS revenue
  FROM long JOIN coefs USING (term)
  LEFT JOIN panel ON panel.panel_id = long.panel_id AND panel.week = long.week
   AND panel.channel = term
  GROUP BY ALL)
"""
)


def _contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regression.contributions(
        _design(spark, sf_dir), src.coefficients(spark), CHANNEL_NAMES
    )


@query(_CONTRIB + "SELECT panel_id, week, component, round(contribution, 3) AS contribution FROM contrib")
def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contributions(spark, sf_dir).select(
        "panel_id", "week", "component", *rounded(3, "contribution")
    )


@query(
    _CONTRIB
    + """SELECT panel_id, component AS channel, round(sum(contribution), 2) AS contribution,
    round(sum(spend), 4) AS spend, round(coalesce(sum(contribution) / nullif(sum(spend), 0), 0), 8) AS roi
    FROM contrib WHERE component <> 'base' GROUP BY ALL"""
)
def channel_roi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regression.channel_roi(_contributions(spark, sf_dir)).select(
        "panel_id", "channel", *rounded(2, "contribution"), *rounded(4, "spend"), *rounded(8, "roi")
    )


@query(
    _CONTRIB
    + """SELECT panel_id, component AS channel, round(sum(contribution) / nullif(sum(spend), 0), 8) AS roi,
    row_number() OVER (PARTITION BY panel_id ORDER BY sum(contribution) / nullif(sum(spend), 0) DESC,
      component) AS best_rank,
    row_number() OVER (PARTITION BY panel_id ORDER BY sum(spend), component) AS smallest_rank
    FROM contrib WHERE component <> 'base' GROUP BY panel_id, component"""
)
def roi_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    roi = regression.channel_roi(_contributions(spark, sf_dir))
    best = panel_window().orderBy(F.desc("roi"), "channel")
    small = panel_window().orderBy("spend", "channel")
    return roi.select(
        "panel_id",
        "channel",
        F.round("roi", 8).alias("roi"),
        F.row_number().over(best).cast("bigint").alias("best_rank"),
        F.row_number().over(small).cast("bigint").alias("smallest_rank"),
    )


@query(
    _CONTRIB
    + """SELECT panel_id, round(sum(contribution) / sum(revenue) * 100, 8) AS base_pct
    FROM contrib WHERE component = 'base' GROUP BY panel_id"""
)
def base_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regression.base_share(_contributions(spark, sf_dir)).select(
        "panel_id", *rounded(8, "base_pct")
    )


_RESID = (
    _CONTRIB.rstrip()
    + """,
resid AS (
  SELECT panel_id, week, t, max(revenue) AS actual, sum(contribution) AS fitted,
         max(revenue) - sum(contribution) AS residual FROM contrib GROUP BY ALL)
"""
)


@query(
    _RESID
    + """SELECT panel_id, week, t, round(actual, 4) AS actual, round(fitted, 3) AS fitted,
    round(residual, 3) AS residual FROM resid"""
)
def fitted_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = regression.fitted_residuals(_contributions(spark, sf_dir))
    return rows.select("panel_id", "week", "t", *rounded(4, "actual"), *rounded(3, "fitted", "residual"))


_STEPS = (
    _RESID.rstrip()
    + """,
steps AS (
  SELECT *, lag(residual) OVER (PARTITION BY panel_id ORDER BY t) AS prev FROM resid)
"""
)


@query(
    _STEPS
    + """SELECT panel_id, round(sum((residual - prev) ** 2) / sum(residual ** 2), 9) AS durbin_watson
    FROM steps GROUP BY panel_id"""
)
def durbin_watson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir).select("panel_id", *rounded(9, "durbin_watson"))


@query(_STEPS + "SELECT panel_id, round(corr(residual, prev), 8) AS lag1_corr FROM steps GROUP BY panel_id")
def residual_autocorr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir).select("panel_id", *rounded(8, "lag1_corr"))


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = regression.fitted_residuals(_contributions(spark, sf_dir))
    return regression.fit_stats(rows, params=len(src.COEFS))


_FIT = " * (ln(2 * pi() * sse / n) + 1)"


@query(
    _RESID
    + f"""SELECT panel_id, n, round(1 - sse / sst, 8) AS r2,
    round(1 - (sse / sst) * (n - 1) / (n - 12), 8) AS adj_r2,
    round(n{_FIT} + 24, 6) AS aic, round(n{_FIT} + 12 * ln(n), 6) AS bic
    FROM (SELECT panel_id, count(*) AS n, sum(residual ** 2) AS sse,
                 var_pop(actual) * count(*) AS sst FROM resid GROUP BY panel_id)"""
)
def fit_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir).select(
        "panel_id", "n", *rounded(8, "r2", "adj_r2"), *rounded(6, "aic", "bic")
    )


_ORDER = ["base", *CHANNEL_NAMES]
_POS = "list_position([" + ", ".join(f"'{c}'" for c in _ORDER) + "], component)"


@query(
    _CONTRIB
    + f"""SELECT panel_id, week, component, CAST({_POS} AS INTEGER) AS pos,
    round(sum(contribution) OVER w - contribution, 3) + 0.0 AS lower_edge,
    round(sum(contribution) OVER w, 3) AS upper_edge FROM contrib
    WINDOW w AS (PARTITION BY panel_id, week ORDER BY {_POS} ROWS UNBOUNDED PRECEDING)"""
)
def decomposition_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = regression.decomposition_stack(_contributions(spark, sf_dir), _ORDER)
    return stack.select(
        "panel_id", "week", "component", "pos",
        (F.round("lower_edge", 3) + 0.0).alias("lower_edge"), *rounded(3, "upper_edge"),
    )


# naive regression: revenue on the raw spend of each channel

_WIDE = (
    W.rstrip()
    + f""",
wide AS (SELECT panel_id, week, sum(revenue) AS revenue, {_PIVOT} FROM panel GROUP BY ALL)
"""
)


def _naive_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_channel = {
        c: F.coalesce(F.sum(F.when(F.col("channel") == c, F.col("spend"))), F.lit(0.0)).alias(c)
        for c in CHANNEL_NAMES
    }
    return src.media_panel(spark, sf_dir).groupBy("panel_id", "week").agg(
        F.sum("revenue").alias("revenue"), *is_channel.values()
    )


def _gram_sql() -> str:
    cols = [*CHANNEL_NAMES, "revenue"]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    return " UNION ALL ".join(
        f"SELECT panel_id, '{a}' AS row_term, '{b}' AS col_term,"
        f" round(covar_pop({a}, {b}) / 1e6, 6) AS covariance FROM wide GROUP BY panel_id"
        for a, b in pairs
    )


@query(_WIDE + _gram_sql())
def gram_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = regression.gram_long(_naive_rows(spark, sf_dir), "panel_id", CHANNEL_NAMES, "revenue")
    return long.withColumn("covariance", F.round(F.col("covariance") / 1e6, 6))


def _ols_ctes(xs: list[str] = CHANNEL_NAMES, table: str = "wide") -> str:
    """CTEs over ``wide`` ending in ``ols(panel_id, term, coef, r2)``: least squares by sweeping one centred regressor at a time out of the later ones, then
    substituting back; shares nothing with the moment-based solver."""
    over = "OVER (PARTITION BY panel_id)"
    cols = ", ".join(f"{c} - avg({c}) {over} AS v0_{i}" for i, c in enumerate([*xs, "revenue"]))
    means = ", ".join(f"avg({c}) {over} AS mean_{i}" for i, c in enumerate([*xs, "revenue"]))
    ctes = [f"s0 AS (SELECT panel_id, {means}, {cols} FROM {table})"]
    n = len(xs)
    for j in range(n):
        coefs = ", ".join(
            f"sum(v{j}_{i} * v{j}_{j}) {over} / sum(v{j}_{j} * v{j}_{j}) {over} AS c_{j}_{i}"
            for i in range(j + 1, n + 1)
        )
        swept = ", ".join(f"v{j}_{i} - c_{j}_{i} * v{j}_{j} AS v{j + 1}_{i}" for i in range(j + 1, n + 1))
        ctes.append(f"r{j} AS (SELECT *, {coefs} FROM s{j})")
        ctes.append(f"s{j + 1} AS (SELECT *, {swept} FROM r{j})")
    back, prev = [], f"s{n}"
    for j in reversed(range(n)):
        rest = "".join(f" - c_{j}_{i} * b_{i}" for i in range(j + 1, n))
        back.append(f"b{j} AS (SELECT *, c_{j}_{n}{rest} AS b_{j} FROM {prev})")
        prev = f"b{j}"
    one = ", ".join([f"any_value(b_{j}) AS b_{j}" for j in range(n)] +
                    [f"any_value(mean_{i}) AS mean_{i}" for i in range(n + 1)])
    ctes += back + [
        f"one AS (SELECT panel_id, {one}, count(*) AS n, sum(v{n}_{n} ** 2) AS sse, sum(v0_{n} ** 2) AS sst"
        f" FROM {prev} GROUP BY panel_id)"
    ]
    const = f"mean_{n}" + "".join(f" - b_{j} * mean_{j}" for j in range(n))
    picks = [f"SELECT panel_id, 'const' AS term, {const} AS coef, 1 - sse / sst AS r2, n, sse FROM one"]
    picks += [
        f"SELECT panel_id, '{c}' AS term, b_{j} AS coef, 1 - sse / sst AS r2, n, sse FROM one"
        for j, c in enumerate(xs)
    ]
    ctes.append("ols AS (" + " UNION ALL ".join(picks) + ")")
    return ",\n" + ",\n".join(ctes) + "\n"


@query(
    _WIDE.rstrip()
    + _ols_ctes()
    + "SELECT panel_id, term, round(coef, 5) AS coef, round(r2, 8) AS r2 FROM ols"
)
def ols_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = regression.ols_fit(_naive_rows(spark, sf_dir), "panel_id", CHANNEL_NAMES, "revenue")
    return fit.select("panel_id", "term", *rounded(5, "coef"), *rounded(8, "r2"))


@query(
    _CONTRIB.rstrip()
    + ",\n"
    + _WIDE[len(W.rstrip()) + 1 :].strip()
    + _ols_ctes()
    + """SELECT o.panel_id, term AS channel, round(any_value(coef), 5) AS naive_roi,
    round(coalesce(sum(contribution) / nullif(sum(spend), 0), 0), 8) AS model_roi
    FROM ols o JOIN contrib c ON c.panel_id = o.panel_id AND component = term GROUP BY ALL"""
)
def roi_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    naive = regression.ols_fit(_naive_rows(spark, sf_dir), "panel_id", CHANNEL_NAMES, "revenue")
    model = regression.channel_roi(_contributions(spark, sf_dir))
    return naive.select(
        "panel_id", F.col("term").alias("channel"), F.round("coef", 5).alias("naive_roi")
    ).join(
        model.select("panel_id", "channel", F.round("roi", 8).alias("model_roi")),
        ["panel_id", "channel"],
    )


_PARAMS = len(CHANNEL_NAMES) + 1


def _alone_ctes() -> str:
    """CTEs ending in ``alone(panel_id, term, own)``: the sum of squares of each channel that the
    constant and all other channels leave, swept out one after the other."""
    over, ctes, last = "OVER (PARTITION BY panel_id)", [], len(CHANNEL_NAMES) - 1
    for name in CHANNEL_NAMES:
        order, at = [*[c for c in CHANNEL_NAMES if c != name], name], f"o_{name}"
        ctes.append(f"{at}_0 AS (SELECT panel_id, " + ", ".join(f"{c} - avg({c}) {over} AS {c}" for c in order) + " FROM wide)")
        for j in range(last):
            swept = ", ".join(f"{c} - {order[j]} * (sum({c} * {order[j]}) {over} / sum({order[j]} * {order[j]}) {over}) AS {c}" for c in order[j + 1 :])
            ctes.append(f"{at}_{j + 1} AS (SELECT panel_id, {swept} FROM {at}_{j})")
    own = " UNION ALL ".join(f"SELECT panel_id, '{c}' AS term, sum({c} * {c}) AS own FROM o_{c}_{last} GROUP BY panel_id" for c in CHANNEL_NAMES)
    return ",\n" + ",\n".join(ctes) + f",\nalone AS ({own})\n"


@query(
    _WIDE.rstrip()
    + _ols_ctes().rstrip()
    + _alone_ctes()
    + f"""SELECT panel_id, term, round(coef, 5) AS coef, round(r2, 8) AS r2,
    round(1 - (1 - r2) * (n - 1) / (n - {_PARAMS}), 8) AS adj_r2,
    round(n * (ln(2 * pi() * sse / n) + 1) + 2 * {_PARAMS}, 5) AS aic,
    round(n * (ln(2 * pi() * sse / n) + 1) + ln(n) * {_PARAMS}, 5) AS bic,
    round(sqrt(sse / (n - {_PARAMS}) / own), 7) AS std_error, round(coef / sqrt(sse / (n - {_PARAMS}) / own), 7) AS t_value,
    true AS p_in_range, true AS inside_interval,
    count(*) FILTER (coef < 0 AND term <> 'const') OVER (PARTITION BY panel_id) AS negative_roi_channels
    FROM ols LEFT JOIN alone USING (panel_id, term)"""
)
def ols_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table of the naive fit, with the number of channels with a negative coefficient; standard error
    and t of the channels; p-values and 95% intervals, which SQL has no Student distribution for, as checks."""
    fit = regression.ols_fit(_naive_rows(spark, sf_dir), "panel_id", CHANNEL_NAMES, "revenue")
    negative = F.count_if((F.col("coef") < 0) & (F.col("term") != "const")).over(panel_window())
    significant = regression.significant(F.col("p_value"))
    outside = ~F.lit(0.0).between(F.col("ci_lo"), F.col("ci_hi"))
    of_channel = lambda c: F.when(F.col("term") != "const", F.round(c, 7)).alias(c)
    return fit.select(
        "panel_id", "term", *rounded(5, "coef"), *rounded(8, "r2", "adj_r2"), *rounded(5, "aic", "bic"),
        of_channel("std_error"), of_channel("t_value"),
        F.col("p_value").between(0, 1).alias("p_in_range"),
        (F.col("coef").between(F.col("ci_lo"), F.col("ci_hi")) & (significant == outside)).alias("inside_interval"),
        negative.alias("negative_roi_channels"),
    )


@query(
    _DESIGN.rstrip()
    + _ols_ctes(_TERMS, "design")
    + "SELECT panel_id, term, round(coef, 6) AS coef, round(r2, 9) AS r2 FROM ols"
)
def mmm_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression on the transformed design: coefficients and fit per panel."""
    fit = regression.ols_fit(_design(spark, sf_dir), "panel_id", _TERMS, "revenue")
    return fit.select("panel_id", "term", *rounded(6, "coef"), *rounded(9, "r2"))


# the whole chain: design, fit, contributions and ROI with the panel's own coefficients

_FITTED = (
    _CONTRIB.rstrip()
    .replace("\nlong AS (", _ols_ctes(_TERMS, "design").strip()[1:].rstrip() + ",\nlong AS (", 1)
    .replace("JOIN coefs USING (term)", "JOIN ols USING (panel_id, term)")
    + "\n"
)


def _fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    design = stage(_design(spark, sf_dir), "design")
    fit = regression.ols_fit(design, "panel_id", _TERMS, "revenue").select("panel_id", "term", "coef")
    return regression.contributions(design, fit, CHANNEL_NAMES, on=["panel_id", "term"])


@query(_FITTED + "SELECT panel_id, week, component, round(contribution, 3) + 0.0 AS contribution FROM contrib")
def fitted_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contributions per week under the coefficients fitted on the panel's design."""
    return _fitted(spark, sf_dir).select(
        "panel_id", "week", "component", (F.round("contribution", 3) + 0.0).alias("contribution")
    )


@query(
    _FITTED
    + """SELECT panel_id, component AS channel, round(sum(spend), 4) AS spend,
    round(coalesce(sum(contribution) / nullif(sum(spend), 0), 0), 5) AS roi
    FROM contrib WHERE component <> 'base' GROUP BY ALL"""
)
def fitted_roi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROI per channel under the fitted coefficients."""
    return regression.channel_roi(_fitted(spark, sf_dir)).select(
        "panel_id", "channel", *rounded(4, "spend"), *rounded(5, "roi")
    )


_NAIVE_FITTED = " + ".join(f"max(coef) FILTER (term = '{c}') * any_value({c})" for c in CHANNEL_NAMES)


@query(
    _WIDE.rstrip()
    + _ols_ctes().rstrip()
    + f""", resid AS (
    SELECT panel_id, week, any_value(revenue) - max(coef) FILTER (term = 'const') - ({_NAIVE_FITTED}) AS residual
    FROM wide JOIN ols USING (panel_id) GROUP BY panel_id, week
    ), steps AS (SELECT *, lag(residual) OVER (PARTITION BY panel_id ORDER BY week) AS prev FROM resid)
    SELECT panel_id, round(sum((residual - prev) ** 2) / sum(residual ** 2), 8) AS durbin_watson,
    round(corr(residual, prev), 8) AS lag1_corr FROM steps GROUP BY panel_id"""
)
def naive_durbin_watson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durbin-Watson and lag-1 correlation of the naive fit's own residuals."""
    rows = stage(_naive_rows(spark, sf_dir), "naive_rows")
    fit = regression.ols_fit(rows, "panel_id", CHANNEL_NAMES, "revenue")
    left = regression.residuals(rows, fit, "panel_id", CHANNEL_NAMES, "revenue")
    weeks = F.floor(F.date_diff("week", F.lit("1970-01-05").cast("date")) / 7)
    stats = regression.fit_stats(
        left.select("panel_id", weeks.alias("t"), F.col("revenue").alias("actual"), "residual"), params=_PARAMS
    )
    return stats.select("panel_id", *rounded(8, "durbin_watson", "lag1_corr"))
