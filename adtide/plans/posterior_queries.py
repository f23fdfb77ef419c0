"""Queries on posterior draws: adstock, revenue, ROI, scenarios, bands, allocation.

The packed series are a few rows per panel out of a scan of all orders and line items; they are
staged once per query, because the plans read them several times. Per-draw results are staged
before their quantiles are taken, for the same reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import change_marker, scenario_verdict as verdict_column
from ..functions.normal import probit_sql
from ..operators import allocation, ordered, panel, posterior
from ..sources import stage
from . import inputs as src
from .inputs import SQL_DRAWS, SQL_LAG_ARRAYS, SQL_PANEL, SQL_SERIES
from .registry import query, rounded

D = "WITH " + SQL_DRAWS.strip() + "\n"
S = "WITH " + SQL_PANEL + ",\n" + SQL_DRAWS.strip() + SQL_SERIES + SQL_LAG_ARRAYS + "\n"
PC = ["panel_id", "channel"]


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(src.panel_series(spark, sf_dir), "series")


def _interval(columns: str, source: str, value: str, digits: int) -> str:
    return (
        f"SELECT {columns}, round(avg({value}), {digits}) AS mean,"
        f" round(quantile_cont({value}, 0.05), {digits}) AS lo,"
        f" round(quantile_cont({value}, 0.95), {digits}) AS hi FROM {source} GROUP BY ALL"
    )


# ------------------------------------------------------------------ draws on their own


@query(D + _interval("panel_id, channel, count(*) AS n", "draws", "beta", 9))
def draw_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ordered.credible_interval(src.draws(spark, sf_dir), PC, "beta")
    return out.select(*PC, "n", *rounded(9, "mean", "lo", "hi"))


@query(
    D.rstrip()
    + ",\nparams AS (SELECT * FROM "
    + src.values_sql("channel, decay, alpha, k_pct", src.PARAM_ROWS)
    + """)
SELECT d.panel_id, d.channel, any_value(p.decay) AS fixed, round(avg(d.decay), 9) AS mean,
  round(quantile_cont(d.decay, 0.05), 9) AS lo, round(quantile_cont(d.decay, 0.95), 9) AS hi
FROM draws d JOIN params p USING (channel) GROUP BY ALL"""
)
def posterior_decay(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = posterior.parameter_summary(src.draws(spark, sf_dir), src.channel_params(spark))
    return out.select(*PC, "fixed", *rounded(9, "mean", "lo", "hi"))


@query(
    D.rstrip()
    + """,
ends AS (
  SELECT channel, min(decay) AS lo, (max(decay) - min(decay)) / 40 AS width, count(*) AS n_total
  FROM draws GROUP BY channel)
SELECT d.channel, CAST(least(floor((decay - lo) / width), 39) AS INTEGER) AS bin, count(*) AS n,
  round(count(*) / (any_value(n_total) * any_value(width)), 9) AS density
FROM draws d JOIN ends USING (channel) GROUP BY ALL"""
)
def histogram_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ordered.equal_width_histogram(
        src.draws(spark, sf_dir), ["channel"], "decay", 40, posterior.DRAW
    )
    return out.select("channel", "bin", "n", *rounded(9, "density"))


_LONG = (
    D.rstrip()
    + """,
long AS (
  SELECT panel_id, chain, draw, concat(name, '_', channel) AS param, value FROM draws
  UNPIVOT (value FOR name IN (decay, sat_k, beta))
  UNION ALL SELECT panel_id, chain, draw, name, value FROM draws_global
  UNPIVOT (value FOR name IN (intercept, sigma)))
"""
)


@query(
    _LONG.rstrip()
    + """,
ends AS (SELECT panel_id, chain, max(draw) AS last FROM long GROUP BY ALL),
halves AS (
  SELECT panel_id, param, chain, draw * 2 > last AS half, count(*) AS n, avg(value) AS mean,
         var_samp(value) AS var FROM long JOIN ends USING (panel_id, chain) GROUP BY ALL)
SELECT panel_id, param, count(*) AS halves,
  round(sqrt(((avg(n) - 1) / avg(n) * avg(var) + var_samp(mean)) / avg(var)), 8) AS rhat
FROM halves GROUP BY ALL"""
)
def split_rhat(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = posterior.long_parameters(src.draws(spark, sf_dir), src.draws_global(spark, sf_dir))
    return posterior.split_rhat(params).select("panel_id", "param", "halves", *rounded(8, "rhat"))


@query(
    _LONG.rstrip()
    + f""",
ends AS (SELECT panel_id, chain, max(draw) AS last FROM long GROUP BY ALL),
medians AS (SELECT panel_id, param, quantile_cont(value, 0.5) AS mid FROM long GROUP BY ALL),
kinds AS (
  SELECT panel_id, chain, draw, param, 'bulk' AS kind, value FROM long UNION ALL
  SELECT panel_id, chain, draw, param, 'tail', abs(value - mid) FROM long JOIN medians USING (panel_id, param)),
ranked AS (
  SELECT *, (rank() OVER w + (count(*) OVER same - 1) / 2 - 0.375::DOUBLE) / (count(*) OVER whole + 0.25::DOUBLE) AS p FROM kinds
  WINDOW w AS (PARTITION BY panel_id, param, kind ORDER BY value), same AS (PARTITION BY panel_id, param, kind, value),
         whole AS (PARTITION BY panel_id, param, kind)),
halves AS (
  SELECT panel_id, param, kind, chain, draw * 2 > last AS half, count(*) AS n, avg(z) AS mean, var_samp(z) AS var
  FROM (SELECT *, {probit_sql("p")} AS z FROM ranked) JOIN ends USING (panel_id, chain) GROUP BY ALL),
rhats AS (
  SELECT panel_id, param, kind, count(*) AS halves, sqrt(((avg(n) - 1) / avg(n) * avg(var) + var_samp(mean)) / avg(var)) AS rhat
  FROM halves GROUP BY ALL)
SELECT panel_id, param, max(halves) AS halves, round(max(rhat), 8) AS rhat FROM rhats GROUP BY ALL"""
)
def rank_rhat(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = posterior.long_parameters(src.draws(spark, sf_dir), src.draws_global(spark, sf_dir))
    return posterior.rank_rhat(params).select("panel_id", "param", "halves", *rounded(8, "rhat"))


@query(
    _LONG.rstrip()
    + """,
ends AS (SELECT panel_id, chain, max(draw) AS last FROM long GROUP BY ALL),
halves AS (
  SELECT panel_id, param, chain, draw * 2 > last AS half, count(*) AS n, avg(value) AS mean,
         var_samp(value) AS var FROM long JOIN ends USING (panel_id, chain) GROUP BY ALL),
rhats AS (
  SELECT panel_id, param, sqrt(((avg(n) - 1) / avg(n) * avg(var) + var_samp(mean)) / avg(var)) AS rhat
  FROM halves GROUP BY ALL),
worst AS (SELECT panel_id, max(rhat) AS max_rhat FROM rhats GROUP BY ALL),
bad AS (SELECT panel_id, count(*) FILTER (sigma > 0.25) AS divergences FROM draws_global GROUP BY ALL)
SELECT panel_id, round(max_rhat, 8) AS max_rhat, divergences, NOT (max_rhat > 1.01 OR divergences > 20) AS converged
FROM worst JOIN bad USING (panel_id)"""
)
def convergence_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The draws carry no divergence mark; a noise level over .25 stands for one here."""
    shared = src.draws_global(spark, sf_dir)
    params = posterior.long_parameters(src.draws(spark, sf_dir), shared)
    bad = shared.groupBy("panel_id").agg(F.count_if(F.col("sigma") > 0.25).alias("divergences"))
    out = posterior.convergence_verdict(posterior.split_rhat(params), bad)
    return out.select("panel_id", *rounded(8, "max_rhat"), "divergences", "converged")


# ------------------------------------------------------------------ draws on the series


@query(
    S
    + """SELECT panel_id, channel, chain, draw, round(sum(adstock), 8) AS adstock_sum,
    round(max(adstock), 9) AS adstock_max FROM draw_adstock GROUP BY ALL"""
)
def adstock_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = [F.sum("adstock").alias("adstock_sum"), F.max("adstock").alias("adstock_max")]
    out = posterior.sum_weeks(src.draws(spark, sf_dir), _series(spark, sf_dir), sums)
    return out.select(*PC, "chain", "draw", *rounded(8, "adstock_sum"), *rounded(9, "adstock_max"))


@query(
    S
    + """SELECT panel_id, channel, t, round(avg(adstock), 9) AS adstock, round(avg(sat_k), 9) AS sat_k,
    round(avg(beta), 9) AS beta FROM draw_adstock GROUP BY ALL"""
)
def posterior_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = posterior.posterior_means(src.draws(spark, sf_dir), _series(spark, sf_dir))
    return means.select(
        *PC, *rounded(9, "sat_k", "beta"), F.posexplode("stock").alias("t", "adstock")
    ).select(*PC, F.col("t").cast("bigint").alias("t"), *rounded(9, "adstock"), "sat_k", "beta")


_REV = (
    S.rstrip()
    + """,
revenue AS (
  SELECT scenario_id, panel_id, channel, chain, draw,
         any_value(revenue_mean) * any_value(beta) * sum(1 - exp(-m * adstock / sat_k)) AS revenue
  FROM draw_adstock JOIN scale USING (panel_id) JOIN scen USING (channel) GROUP BY ALL),
total AS (
  SELECT scenario_id, panel_id, chain, draw, sum(revenue) AS revenue FROM revenue GROUP BY ALL),
uplift AS (
  SELECT *, revenue - max(revenue) FILTER (scenario_id = 'current')
    OVER (PARTITION BY panel_id, chain, draw) AS uplift FROM total)
"""
)


@query(_REV + "SELECT scenario_id, panel_id, chain, draw, channel, round(revenue, 2) AS revenue FROM revenue")
def channel_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posterior.channel_revenue(
        src.draws(spark, sf_dir), _series(spark, sf_dir), src.scenarios(spark)
    ).withColumn("revenue", F.round("revenue", 2))


@query(_REV + "SELECT scenario_id, panel_id, chain, draw, round(revenue, 1) AS revenue FROM total")
def scenario_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scenario_revenue(spark, sf_dir).withColumn("revenue", F.round("revenue", 1))


def _scenario_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posterior.scenario_revenue(
        src.draws(spark, sf_dir), _series(spark, sf_dir), src.scenarios(spark)
    )


@query(
    _REV
    + """SELECT scenario_id, panel_id, chain, draw, round(revenue, 1) AS revenue,
    round(uplift, 1) + 0.0 AS uplift FROM uplift"""
)
def uplift_by_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posterior.uplift_by_draw(_scenario_revenue(spark, sf_dir)).select(
        "scenario_id", *posterior.DRAW, *rounded(1, "revenue"),
        (F.round("uplift", 1) + 0.0).alias("uplift"),
    )


def _uplift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-draw uplifts, staged: one row per scenario and draw out of weeks x draws rows."""
    return stage(posterior.uplift_by_draw(_scenario_revenue(spark, sf_dir)), "uplift")


@query(
    _REV
    + """SELECT panel_id, scenario_id, count(*) AS n, round(avg(uplift), 2) + 0.0 AS mean,
    round(quantile_cont(uplift, 0.05), 2) + 0.0 AS lo, round(quantile_cont(uplift, 0.95), 2) + 0.0 AS hi,
    round(avg(CAST(uplift > 0 AS INTEGER)), 9) AS p_gain FROM uplift GROUP BY ALL"""
)
def uplift_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = posterior.uplift_summary(_uplift(spark, sf_dir))
    return out.select(
        "panel_id", "scenario_id", "n",
        *[(F.round(c, 2) + 0.0).alias(c) for c in ("mean", "lo", "hi")],
        *rounded(9, "p_gain"),
    )


@query(
    _REV.rstrip()
    + """,
changed AS (SELECT * FROM uplift WHERE scenario_id <> 'current'),
ends AS (
  SELECT scenario_id, min(uplift) AS lo, (max(uplift) - min(uplift)) / 50 AS width
  FROM changed GROUP BY scenario_id)
SELECT scenario_id, CAST(least(floor((uplift - lo) / width), 49) AS INTEGER) AS bin, count(*) AS n
FROM changed JOIN ends USING (scenario_id) GROUP BY ALL"""
)
def histogram_uplift(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = _uplift(spark, sf_dir).where(F.col("scenario_id") != "current")
    out = ordered.equal_width_histogram(changed, ["scenario_id"], "uplift", 50, posterior.DRAW)
    return out.select("scenario_id", "bin", "n")


@query(
    S.rstrip()
    + """,
roi AS (
  SELECT panel_id, channel, chain, draw, any_value(spend_total) AS spend_total,
         any_value(revenue_mean) * any_value(beta) * sum(1 - exp(-adstock / sat_k))
           / nullif(any_value(spend_total), 0) AS roi
  FROM draw_adstock JOIN scale USING (panel_id) JOIN totals USING (panel_id, channel) GROUP BY ALL)
SELECT r.panel_id, r.channel, round(avg(coalesce(roi, 0)), 7) AS roi_mean,
  round(quantile_cont(coalesce(roi, 0), 0.05), 7) AS roi_lo,
  round(quantile_cont(coalesce(roi, 0), 0.95), 7) AS roi_hi,
  round(any_value(r.spend_total) * 100 / any_value(panel_total), 8) AS budget_share_pct,
  round(any_value(r.spend_total), 4) AS spend_total
FROM roi r JOIN (SELECT panel_id, sum(spend_total) AS panel_total FROM totals GROUP BY panel_id)
  USING (panel_id) GROUP BY ALL"""
)
def posterior_roi(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = _series(spark, sf_dir)
    roi = stage(posterior.roi_by_draw(src.draws(spark, sf_dir), series), "roi")
    out = posterior.posterior_roi(roi, series)
    return out.select(
        *PC, *rounded(7, "roi_mean", "roi_lo", "roi_hi"), *rounded(8, "budget_share_pct"),
        *rounded(4, "spend_total"),
    )


_SEASON = " + ".join(
    f"season_{2 * (h - 1) + i} * {fn}(2 * pi() * {h} * t / 52.18)"
    for h in (1, 2)
    for i, fn in enumerate(("sin", "cos"))
)


@query(
    S.rstrip()
    + f""",
media AS (
  SELECT panel_id, chain, draw, t, sum(beta * (1 - exp(-adstock / sat_k))) AS media
  FROM draw_adstock GROUP BY ALL),
rival AS (
  SELECT *, coalesce(competitor / nullif(max(competitor) OVER (PARTITION BY panel_id), 0), 0) AS rival
  FROM weekly),
mu AS (
  SELECT panel_id, week, t, revenue_mean * (media + intercept + {_SEASON} + trend * t / n_weeks
    + comp * rival) AS mu
  FROM media JOIN draws_global USING (panel_id, chain, draw) JOIN rival USING (panel_id, t)
  JOIN scale USING (panel_id))
"""
    + _interval("panel_id, week, CAST(t AS INTEGER) AS t", "mu", "mu", 3)
)
def predictive_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    dense = stage(src.media_panel(spark, sf_dir), "panel")
    weekly = stage(panel.pack_weekly(dense), "weekly")
    mu = posterior.expected_by_draw(
        src.draws(spark, sf_dir),
        src.draws_global(spark, sf_dir),
        stage(panel.pack_series(dense), "series"),
        weekly,
    )
    out = posterior.predictive_band(stage(mu.select("panel_id", "t", "mu"), "mu"), weekly)
    return out.select("panel_id", "week", "t", *rounded(3, "mean", "lo", "hi"))


# ------------------------------------------------------------------ scenarios and allocation


@query(
    S
    + """SELECT panel_id, scenario_id, channel, round(m * spend_total, 6) AS selected_eur,
    round(m * spend_total / sum(m * spend_total) OVER w * 100, 8) AS selected_pct,
    round((sum(m * spend_total) OVER w - sum(spend_total) OVER w) / sum(spend_total) OVER w * 100, 8) + 0.0
      AS drift_pct
    FROM totals JOIN scen USING (channel) WINDOW w AS (PARTITION BY panel_id, scenario_id)"""
)
def scenario_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = panel.budget_share(src.media_panel(spark, sf_dir))
    out = allocation.scenario_budget(totals, src.scenarios(spark))
    return out.select(
        "panel_id", "scenario_id", "channel",
        *rounded(6, "selected_eur"), *rounded(8, "selected_pct"),
        (F.round("drift_pct", 8) + 0.0).alias("drift_pct"),
    )


@query(
    _REV.rstrip()
    + """,
mean_uplift AS (SELECT panel_id, scenario_id, avg(uplift) AS mean_uplift FROM uplift GROUP BY ALL),
budget AS (
  SELECT panel_id, scenario_id, sum(m * spend_total) AS selected, sum(spend_total) AS now_total
  FROM totals JOIN scen USING (channel) GROUP BY ALL)
SELECT panel_id, scenario_id,
  CASE WHEN abs(selected - now_total) / now_total > 0.05 THEN 'warning'
       WHEN mean_uplift > 0 THEN 'improves' ELSE 'no_gain' END AS verdict
FROM mean_uplift JOIN budget USING (panel_id, scenario_id)"""
)
def scenario_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = _series(spark, sf_dir)
    scen = src.scenarios(spark)
    revenue = posterior.scenario_revenue(src.draws(spark, sf_dir), series, scen)
    gains = posterior.uplift_by_draw(revenue).groupBy("panel_id", "scenario_id").agg(
        F.avg("uplift").alias("mean_uplift")
    )
    budgets = series.join(scen, "channel").groupBy("panel_id", "scenario_id").agg(
        F.sum(F.col("m") * F.col("spend_total")).alias("selected"),
        F.sum("spend_total").alias("current"),
    )
    return gains.join(budgets, ["panel_id", "scenario_id"]).select(
        "panel_id", "scenario_id",
        verdict_column(F.col("selected"), F.col("current"), F.col("mean_uplift")).alias("verdict"),
    )


def _means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(posterior.posterior_means(src.draws(spark, sf_dir), _series(spark, sf_dir)), "means")


_MEANS = (
    S.rstrip()
    + """,
stock AS (SELECT panel_id, channel, t, avg(adstock) AS a FROM draw_adstock GROUP BY ALL),
means AS (
  SELECT panel_id, channel, avg(sat_k) AS k, avg(beta) AS beta, any_value(revenue_mean) AS revenue_mean,
         any_value(spend_total) AS spend_total
  FROM draws JOIN scale USING (panel_id) JOIN totals USING (panel_id, channel) GROUP BY ALL)
"""
)


def _fill_sql(name: str, bounds: str, steps: int) -> str:
    """One greedy pass over ``bounds(panel_id, channel, lo, hi)`` giving ``name(.., multiplier)``."""
    return f""",
{name}_free AS (
  SELECT panel_id, sum(spend_total) - sum(lo * spend_total) AS free
  FROM {bounds} JOIN means USING (panel_id, channel) GROUP BY panel_id),
{name}_at AS (
  SELECT panel_id, channel, step, (hi - lo) / {steps} AS width, lo,
         revenue_mean * beta * sum(1 - exp(-(lo + step * ((hi - lo) / {steps})) * a / k)) AS revenue,
         spend_total
  FROM {bounds} JOIN means USING (panel_id, channel) JOIN stock USING (panel_id, channel),
       range({steps + 1}) AS r(step)
  GROUP BY panel_id, channel, step, lo, hi, spend_total, revenue_mean, beta),
{name}_step AS (
  SELECT *, width * spend_total AS cost,
         lead(revenue) OVER (PARTITION BY panel_id, channel ORDER BY step) - revenue AS gain
  FROM {name}_at),
{name}_run AS (
  SELECT *, sum(cost) OVER (PARTITION BY panel_id ORDER BY gain / cost DESC, channel, step
                            ROWS UNBOUNDED PRECEDING) - cost AS before
  FROM {name}_step WHERE gain IS NOT NULL AND cost > 0),
{name} AS (
  SELECT panel_id, channel,
         any_value(lo) + any_value(width) * sum(least(greatest((free - before) / cost, 0), 1)) AS multiplier
  FROM {name}_run JOIN {name}_free USING (panel_id) GROUP BY ALL)"""


_ALLOC = (
    _MEANS.rstrip()
    + ",\nwide_bounds AS (SELECT panel_id, channel, 0.3::DOUBLE AS lo, 2.0::DOUBLE AS hi FROM means)"
    + _fill_sql("coarse", "wide_bounds", allocation.STEPS)
    + """,
near_bounds AS (
  SELECT panel_id, channel,
         greatest(multiplier - 1.7 / 340 * sum(spend_total) OVER w / spend_total, 0.3) AS lo,
         least(multiplier + 1.7 / 340 * sum(spend_total) OVER w / spend_total, 2.0) AS hi
  FROM coarse JOIN means USING (panel_id, channel) WINDOW w AS (PARTITION BY panel_id))"""
    + _fill_sql("best", "near_bounds", allocation.FINE_STEPS)
    + "\n"
)


@query(_ALLOC + "SELECT panel_id, channel, round(multiplier, 6) AS multiplier FROM best")
def budget_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocation.budget_allocation(_means(spark, sf_dir)).select(*PC, *rounded(6, "multiplier"))


# Halvings of the price (45) with, inside each and once more at the end, halvings of every multiplier.
@query(
    _MEANS.replace("WITH", "WITH RECURSIVE", 1).rstrip()
    + """,
curve AS (
  SELECT panel_id, channel, spend_total, k, revenue_mean * beta / k / spend_total AS scale, list(a ORDER BY t) AS stock
  FROM means JOIN stock USING (panel_id, channel) WHERE spend_total > 0 GROUP BY ALL),
search AS (
  SELECT *, 0 AS n, -40.0::DOUBLE AS low, 40.0::DOUBLE AS high, 0.3::DOUBLE AS lo, 2.0::DOUBLE AS hi,
         sum(spend_total) OVER (PARTITION BY panel_id) AS budget FROM curve
  UNION ALL
  SELECT panel_id, channel, spend_total, k, scale, stock, n + 1,
    CASE WHEN turn AND spent >= budget THEN (low + high) / 2 ELSE low END,
    CASE WHEN turn AND spent < budget THEN (low + high) / 2 ELSE high END,
    CASE WHEN turn THEN 0.3 ELSE lo2 END, CASE WHEN turn THEN 2.0 ELSE hi2 END, budget
  FROM (SELECT *, n % 45 = 44 AND n < 50 * 45 AS turn, sum(spend_total * lo2) OVER (PARTITION BY panel_id) AS spent
        FROM (SELECT *, CASE WHEN worth THEN (lo + hi) / 2 ELSE lo END AS lo2, CASE WHEN worth THEN hi ELSE (lo + hi) / 2 END AS hi2
              FROM (SELECT *, ln(scale * list_sum(list_transform(stock, lambda x: x * exp(-(lo + hi) / 2 * x / k)))) > (low + high) / 2
                      AS worth FROM search WHERE n < 51 * 45))))
SELECT panel_id, channel, round(coalesce(lo, 1.0), 6) AS multiplier,
  round(scale * list_sum(list_transform(stock, lambda x: x * exp(-lo * x / search.k))), 6) AS marginal
FROM means LEFT JOIN search USING (panel_id, channel) WHERE n = 51 * 45 OR n IS NULL"""
)
def optimal_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = allocation.optimal_allocation(_means(spark, sf_dir))
    return best.select(*PC, *rounded(6, "multiplier", "marginal"))


@query(
    _ALLOC
    + """SELECT panel_id, channel, round(spend_total, 4) AS current_eur,
    round(spend_total / sum(spend_total) OVER w * 100, 8) AS current_pct,
    round(multiplier * spend_total, 1) AS recommended_eur,
    round(multiplier * spend_total / sum(multiplier * spend_total) OVER w * 100, 6) AS recommended_pct,
    round(multiplier, 6) AS multiplier,
    CASE WHEN multiplier > 1.02 THEN 'up' WHEN multiplier < 0.98 THEN 'down' ELSE 'equal' END AS direction
    FROM best JOIN means USING (panel_id, channel) WINDOW w AS (PARTITION BY panel_id)"""
)
def allocation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = allocation.allocation_table(allocation.budget_allocation(_means(spark, sf_dir)))
    return table.select(
        *PC, *rounded(4, "current_eur"), *rounded(8, "current_pct"), *rounded(1, "recommended_eur"),
        *rounded(6, "recommended_pct", "multiplier"), "direction",
    )


@query(
    S
    + """SELECT panel_id, channel, round(m, 9) AS multiplier,
    CASE WHEN m > 1.02 THEN 'up' WHEN m < 0.98 THEN 'down' ELSE 'equal' END AS direction
    FROM (SELECT panel_id, channel, spend_total / avg(spend_total) OVER (PARTITION BY panel_id) AS m
          FROM totals)"""
)
def allocation_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direction of every channel's spend against an equal split."""
    totals = panel.budget_share(src.media_panel(spark, sf_dir))
    m = F.col("spend_total") / F.avg("spend_total").over(panel.panel_window())
    return totals.select(*PC, F.round(m, 9).alias("multiplier"), change_marker(m).alias("direction"))


@query(
    _MEANS
    + """SELECT panel_id, channel, CAST(step AS INTEGER) AS step, round(step * 2 / 119, 9) AS m,
    round(step * 2 / 119 * spend_total, 4) AS spend,
    round(revenue_mean * beta * sum(1 - exp(-(step * 2 / 119) * a / k)), 3) AS revenue
    FROM means JOIN stock USING (panel_id, channel), range(120) AS r(step)
    GROUP BY panel_id, channel, step, spend_total, revenue_mean, beta"""
)
def response_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocation.response_curve(_means(spark, sf_dir)).select(
        *PC, "step", *rounded(9, "m"), *rounded(4, "spend"), *rounded(3, "revenue")
    )


@query(
    _ALLOC
    + """, marked AS (
    SELECT panel_id, channel, 'current' AS point, 1.0::DOUBLE AS m FROM best
    UNION ALL SELECT panel_id, channel, 'recommended', multiplier FROM best)
    SELECT panel_id, channel, point, round(m, 6) AS m, round(m * spend_total, 1) AS spend,
    round(revenue_mean * beta * sum(1 - exp(-m * a / k)), 1) AS revenue
    FROM marked JOIN means USING (panel_id, channel) JOIN stock USING (panel_id, channel)
    GROUP BY panel_id, channel, point, m, spend_total, revenue_mean, beta"""
)
def response_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = _means(spark, sf_dir)
    points = allocation.marked_points(means, allocation.budget_allocation(means))
    return points.select(*PC, "point", *rounded(6, "m"), *rounded(1, "spend", "revenue"))


