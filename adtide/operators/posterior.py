"""Operators over posterior draws: adstock, revenue, ROI, scenarios, bands, convergence.

``draws`` has one row per (panel_id, chain, draw, channel) with decay, sat_k and beta; ``series``
is one packed row per (panel_id, channel). Draws are placed by (panel_id, chain, draw) first: a
row is small but stands for weeks x scenarios of work, and a hot panel is spread over all tasks.
A draw then meets its packed series, is expanded to weeks inside the task and summed back there.
Weeks are summed under whole numbers for the series, since the keys cost most there; after that only
per-draw sums move. A hot series is dealt over copies by ``skew_join``.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exponential_saturation, lag_weights, safe_ratio
from ..functions.media import MAX_LAG
from ..functions.normal import probit
from ..sources.files import spread_rows, stage
from .carryover import weighted_lags
from .ordered import credible_interval, exact_quantiles, running_totals, skew_join

# Task functions travel by value, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DRAW = ["panel_id", "chain", "draw"]
#: Scenarios that share one lag sum.
TOGETHER = 50
#: Draws x weeks that a task holds in one matrix.
CELLS = 1 << 19


def by_draw(df: DataFrame) -> DataFrame:
    """Rows placed by draw; the count is fixed because AQE would merge the small rows again."""
    return spread_rows(df, DRAW)


def draw_adstock(draws: DataFrame, series: DataFrame, max_lag: int = MAX_LAG) -> DataFrame:
    """Normalised adstock of every draw and week: adds t, adstock and the series constants."""
    names = [f"_w{i}" for i in range(max_lag)]
    weights = [w.alias(n) for w, n in zip(lag_weights(F.col("decay"), max_lag), names)]
    # zeros stand before the start, past the end and for a null, so a week's lag sum has no case to tell apart
    known = F.transform(F.coalesce("xs", F.array().cast("array<double>")), lambda x: F.coalesce(x, F.lit(0.0)))
    past = F.greatest(F.col("n_weeks") - F.size(known), F.lit(0)).cast("int")
    padded = F.concat(F.array_repeat(F.lit(0.0), max_lag - 1), known, F.array_repeat(F.lit(0.0), past))
    rows = skew_join(
        by_draw(draws).select("*", *weights), series.withColumn("xs", padded), ["panel_id", "channel"], ["chain", "draw"]
    )
    rows = rows.select(
        "*", F.explode(F.sequence(F.lit(0), F.col("n_weeks").cast("int") - 1)).alias("t")
    )
    terms = [F.col(n) * F.get("xs", F.col("t") + (max_lag - 1 - i)) for i, n in enumerate(names)]
    return rows.withColumn("adstock", sum(terms[1:], terms[0])).drop("xs", *names)


def sum_weeks(
    draws: DataFrame, series: DataFrame, sums: list[Column], also: list[str] | None = None
) -> DataFrame:
    """Aggregates over the weeks of ``draw_adstock``, one row per draw and channel (and ``also``).

    A row per draw and week meets the hash table of its draw, so the keys are what costs most: a whole
    number names the series there, and its panel and channel come back with the sums. The numbers
    are stored, since both readers have to see the same.
    """
    numbered = stage(series.withColumn("_s", F.monotonically_increasing_id()), "numbered")
    rows = draw_adstock(draws, numbered)
    summed = rows.groupBy("_s", "chain", "draw", *(also or [])).agg(*sums)
    return summed.join(numbered.select("_s", "panel_id", "channel"), "_s").drop("_s")


def channel_revenue(draws: DataFrame, series: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Revenue of a channel per scenario and draw: revenue_mean * beta * sum_t sat(m * adstock).

    The scenarios of a channel travel with its draws as one array of multipliers. The lag sum of a
    week is formed once and meets all of them, each with a sum of its own, ``TOGETHER`` at a time.
    """
    on = [c for c in ("panel_id", "channel") if c in scenarios.columns]
    place = F.row_number().over(Window.partitionBy(*on).orderBy("scenario_id")) - 1
    numbered = scenarios.select(*on, "scenario_id", "m", place.alias("_j"))
    chunk, within = F.floor(F.col("_j") / TOGETHER).alias("_chunk"), (F.col("_j") % TOGETHER).alias("_j")
    numbered = stage(numbered.select(*on, "scenario_id", "m", chunk, within), "scenarios")
    packed = numbered.groupBy(*on, "_chunk").agg(F.transform(F.sort_array(F.collect_list(F.struct("_j", "m"))), lambda s: s["m"]).alias("_ms"))
    packed = stage(packed, "multipliers")
    most = packed.agg(F.max(F.size("_ms"))).first()[0] or 1
    sums = [
        F.sum(F.col("revenue_mean") * F.col("beta") * exponential_saturation(F.get("_ms", F.lit(j)) * F.col("adstock"), F.col("sat_k"))).alias(f"_r{j}")
        for j in range(most)
    ]
    summed = sum_weeks(draws.join(packed, on), series, sums, ["_chunk"])
    each = F.inline(F.array(*[F.struct(F.lit(j).alias("_j"), F.col(f"_r{j}").alias("revenue")) for j in range(most)]))
    return summed.select(*DRAW, "channel", "_chunk", each).join(numbered.drop("m"), [*on, "_chunk", "_j"]).select(
        "scenario_id", *DRAW, "channel", "revenue"
    )


def scenario_revenue(draws: DataFrame, series: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Media revenue of all channels per scenario and draw."""
    per_channel = channel_revenue(draws, series, scenarios)
    return per_channel.groupBy("scenario_id", *DRAW).agg(F.sum("revenue").alias("revenue"))


def uplift_by_draw(revenue: DataFrame, base: str = "current") -> DataFrame:
    """Each scenario's revenue minus the base scenario's, draw by draw."""
    per_draw = Window.partitionBy(*DRAW)
    current = F.max(F.when(F.col("scenario_id") == base, F.col("revenue"))).over(per_draw)
    return revenue.withColumn("uplift", F.col("revenue") - current)


def uplift_summary(uplift: DataFrame) -> DataFrame:
    """Mean, 5 and 95 percent, and probability of a gain per scenario and panel."""
    marked = uplift.withColumn("gain", (F.col("uplift") > 0).cast("int"))
    out = exact_quantiles(
        marked, ["panel_id", "scenario_id"], "uplift", {"lo": 0.05, "hi": 0.95}, totals=["gain"]
    )
    return out.withColumn("p_gain", F.col("gain") / F.col("n")).drop("gain")


def roi_by_draw(draws: DataFrame, series: DataFrame) -> DataFrame:
    """Revenue of a channel over its spend, draw by draw; 0 without spend."""
    sat = exponential_saturation(F.col("adstock"), F.col("sat_k"))
    worth = F.sum(F.col("revenue_mean") * F.col("beta") * sat)
    return sum_weeks(draws, series, [safe_ratio(worth, F.max("spend_total")).alias("roi")]).select(*DRAW, "channel", "roi")


def posterior_roi(roi: DataFrame, series: DataFrame) -> DataFrame:
    """ROI per channel: mean, 5 and 95 percent over draws, share of budget and total spend."""
    panel = Window.partitionBy("panel_id")
    spend = series.select(
        "panel_id",
        "channel",
        "spend_total",
        (safe_ratio(F.col("spend_total"), F.sum("spend_total").over(panel)) * 100).alias(
            "budget_share_pct"
        ),
    )
    return (
        credible_interval(roi, ["panel_id", "channel"], "roi")
        .join(spend, ["panel_id", "channel"])
        .select(
            "panel_id",
            "channel",
            F.col("mean").alias("roi_mean"),
            F.col("lo").alias("roi_lo"),
            F.col("hi").alias("roi_hi"),
            "budget_share_pct",
            "spend_total",
        )
    )


def parameter_summary(draws: DataFrame, params: DataFrame, column: str = "decay") -> DataFrame:
    """Posterior mean and interval of a channel parameter next to its fixed value."""
    fixed = params.select("channel", F.col(column).alias("fixed"))
    return credible_interval(draws, ["panel_id", "channel"], column).join(fixed, "channel")


def posterior_means(draws: DataFrame, series: DataFrame, max_lag: int = MAX_LAG) -> DataFrame:
    """One row per series with mean parameters and ``stock``, the mean adstock by t.

    Adstock is linear in the weights, so the mean over draws is the adstock of the mean weights:
    draws are averaged first and never expanded to weeks.
    """
    means = draws.groupBy("panel_id", "channel").agg(
        F.array(*[F.avg(w) for w in lag_weights(F.col("decay"), max_lag)]).alias("_w"),
        F.avg("sat_k").alias("sat_k"),
        F.avg("beta").alias("beta"),
    )
    weights = [F.col("_w")[i] for i in range(max_lag)]
    stock = F.transform("xs", lambda _, t: weighted_lags(weights, F.col("xs"), t))
    return series.join(means, ["panel_id", "channel"]).withColumn("stock", stock).drop("_w", "xs")


def _lag_matrix(xs: pa.Array, t: np.ndarray, max_lag: int) -> np.ndarray:
    """One row per lag with ``xs[t - lag]``; 0 outside the array and for a null."""
    x = np.zeros(0) if xs is None else pc.fill_null(xs, 0.0).to_numpy(zero_copy_only=False)
    x = np.append(x, 0.0)  # the last place answers for all places outside
    at = t[None, :] - np.arange(max_lag)[:, None]
    return x[np.where((at >= 0) & (at < len(x) - 1), at, len(x) - 1)]


def _media(params: pa.StructArray, lags: np.ndarray) -> np.ndarray:
    """beta * saturation of a channel by draw and week; a draw with a null among its parameters adds nothing."""
    one = [pc.struct_field(params, name) for name in ("decay", "sat_k", "beta")]
    known = np.logical_and.reduce([np.asarray(c.is_valid()) for c in one])
    decay, sat_k, beta = (np.where(known, pc.fill_null(c, 0.0).to_numpy(zero_copy_only=False), other) for c, other in zip(one, (0.0, 1.0, 0.0)))
    weights = decay[:, None] ** np.arange(float(len(lags)))
    with np.errstate(divide="raise", invalid="raise"):  # as Spark's division
        weights /= weights.sum(axis=1, keepdims=True)
        depth = (weights @ lags) / -sat_k[:, None]
    return -beta[:, None] * np.expm1(depth)


def _expected(rows: pa.RecordBatch, max_lag: int) -> pa.ListArray:
    """The weeks of each row with t and mu; all rows are draws of one panel, whose series and calendar each of them carries."""
    weeks = rows.column("weeks")[0].values
    t = pc.struct_field(weeks, "t").to_numpy().astype(np.int64)
    base = ["intercept", *[f"season_{i}" for i in range(4)], "trend", "comp"]
    calendar = [pc.struct_field(weeks, name) for name in (*[f"season_{i}" for i in range(4)], "trend", "competitor")]
    number = lambda c: pc.fill_null(c.cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False)
    unknown = lambda cs: np.logical_or.reduce([np.asarray(c.is_null()) for c in cs])
    shared = np.stack([number(rows.column(name)) for name in base], axis=1)
    mu = shared[:, :1] + shared[:, 1:] @ np.stack([number(c) for c in calendar])
    series = rows.column("_xs")[0].values
    params = rows.column("_of").flatten()
    for i, xs in enumerate(series):
        mine = params.take(pa.array(np.arange(rows.num_rows) * len(series) + i))
        mu += _media(mine, _lag_matrix(xs.values, t, max_lag))
    null = unknown([rows.column(name) for name in base])[:, None] | unknown(calendar)[None, :]
    each = pa.StructArray.from_arrays(
        [pa.array(np.tile(t, rows.num_rows), pa.int32()), pa.array(mu.ravel(), pa.float64(), mask=null.ravel())], names=["t", "mu"]
    )
    return pa.ListArray.from_arrays(pa.array(np.arange(rows.num_rows + 1) * len(t), pa.int32()), each)


def _expected_task(max_lag: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            panel = batch.column("panel_id").dictionary_encode().indices.to_numpy()
            for p in range(panel.max() + 1 if len(panel) else 0):
                at = np.flatnonzero(panel == p)
                weeks = len(batch.column("weeks")[int(at[0])])
                step = max(1, CELLS // max(weeks, 1))
                for start in range(0, len(at) if weeks else 0, step):
                    rows = batch.take(pa.array(at[start : start + step]))
                    yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in DRAW], _expected(rows, max_lag)], names=[*DRAW, "_weeks"])

    return run


def expected_by_draw(
    draws: DataFrame, globals_: DataFrame, series: DataFrame, weekly: DataFrame, max_lag: int = MAX_LAG
) -> DataFrame:
    """(panel_id, chain, draw, t, mu): expected revenue of every draw and week, scaled.

    A draw becomes one row with the parameters of all its channels beside its globals, and a panel one
    row with all its series and its calendar. They meet once; the tasks form ``mu`` of their draws
    as matrices of draws x weeks, at most ``CELLS`` at a time, so no rows of draws x weeks are merged
    again and the cost of a week does not jump with the number of channels. A channel without
    parameters in the draw, or a draw without any, adds nothing.
    """
    panels = series.groupBy("panel_id").agg(F.sort_array(F.collect_list(F.struct("channel", "xs"))).alias("_series"))
    panels = panels.select("panel_id", F.col("_series.channel").alias("_channels"), F.col("_series.xs").alias("_xs"))
    panels = stage(panels.join(weekly.select("panel_id", "weeks"), "panel_id"), "panels")
    entry = F.struct("channel", F.struct("decay", "sat_k", "beta"))
    packed = by_draw(draws).groupBy(*DRAW).agg(F.map_from_entries(F.collect_list(entry)).alias("_params"))
    rows = by_draw(globals_).join(packed, DRAW, "left")
    rows = skew_join(rows, panels, ["panel_id"], ["chain", "draw"])
    shared = ["intercept", *[f"season_{i}" for i in range(4)], "trend", "comp"]
    rows = rows.select(*DRAW, *shared, "_xs", "weeks", F.transform("_channels", lambda c: F.try_element_at("_params", c)).alias("_of"))
    week = T.StructType([T.StructField("t", T.IntegerType()), T.StructField("mu", T.DoubleType())])
    schema = T.StructType([*[rows.schema[c] for c in DRAW], T.StructField("_weeks", T.ArrayType(week))])
    return rows.mapInArrow(_expected_task(max_lag), schema).select(*DRAW, F.explode("_weeks").alias("wk")).select(*DRAW, "wk.t", "wk.mu")


def predictive_band(mu: DataFrame, weekly: DataFrame) -> DataFrame:
    """(panel_id, week, t, mean, lo, hi) of expected revenue."""
    band = credible_interval(mu, ["panel_id", "t"], "mu")
    calendar = weekly.select("panel_id", "revenue_mean", F.explode("weeks").alias("wk")).select(
        "panel_id", "revenue_mean", F.col("wk.week").alias("week"), F.col("wk.t").cast("int").alias("t")
    )
    return band.join(calendar, ["panel_id", "t"]).select(
        "panel_id",
        "week",
        "t",
        *[(F.col(c) * F.col("revenue_mean")).alias(c) for c in ("mean", "lo", "hi")],
    )


def long_parameters(draws: DataFrame, globals_: DataFrame) -> DataFrame:
    """(panel_id, chain, draw, param, value) of the parameters whose convergence is checked."""
    per_channel = draws.unpivot(
        [*DRAW, "channel"], ["decay", "sat_k", "beta"], "name", "value"
    ).select(*DRAW, F.concat_ws("_", "name", "channel").alias("param"), "value")
    shared = globals_.unpivot(DRAW, ["intercept", "sigma"], "param", "value")
    return per_channel.unionByName(shared)


def split_rhat(params: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Split R-hat per (panel_id, param), or per ``by``: chains are halved at the middle draw index,
    then the variance between halves is compared with the variance inside them. Values are taken as
    they are; see ``rank_rhat``. Two aggregates; no draw leaves its task unsummed."""
    by = by or ["panel_id", "param"]
    ends = stage(params.groupBy("panel_id", "chain").agg(F.max("draw").alias("_last"), F.count("*").alias("_rows")), "ends")
    half = (F.col("draw") * 2 > F.col("_last")).cast("int")
    halves = (
        skew_join(params, ends.drop("_rows"), ["panel_id", "chain"], ["draw", "param"], counts=ends)
        .groupBy(*by, "chain", half.alias("half"))
        .agg(
            F.count("*").alias("n"),
            F.avg("value").alias("mean"),
            F.var_samp("value").alias("var"),
        )
    )
    within, n = F.avg("var"), F.avg("n")
    pooled = (n - 1) / n * within + F.var_samp("mean")
    return halves.groupBy(*by).agg(
        F.sqrt(F.try_divide(pooled, within)).alias("rhat"), F.count("*").alias("halves")
    )


def rank_normalised(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``df`` with ``value`` replaced by the normal quantile of (rank - 3/8) / (n + 1/4) in its group;
    equal values share their middle rank. Rows with a null value are left out.

    Ranks come from running totals over ranges of values, so no group is ordered in one task. They are
    stored before they meet the rows: the planner then sees which side is the smaller one. Repeated
    values make the rows small on disk, and they would be sent to the few tasks that hold the ranks.
    """
    rows = stage(df.where(F.col(value).isNotNull()), "ranked")
    totals = running_totals(rows.withColumn("_n", F.lit(1)), keys, value, ["_n"])
    middle = F.col("_n_cum") - (F.col("_n") - 1) / 2
    scored = totals.select(*keys, value, ((middle - 0.375) / (F.col("_n_total") + 0.25)).alias("_p"))
    return rows.join(stage(scored, "scored"), [*keys, value]).withColumn(value, probit("_p")).drop("_p")


def rank_rhat(params: DataFrame) -> DataFrame:
    """(panel_id, param, rhat, halves): the larger of split R-hat over rank-normalised values, which
    sees chains in different places, and over rank-normalised distances from the median, which sees
    chains of different width. Finite for heavy tails, where plain R-hat is not."""
    keys = ["panel_id", "param"]
    present = stage(params.where(F.col("value").isNotNull()).select(*keys, "chain", "draw", "value"), "params")
    middle = exact_quantiles(present, keys, "value", {"_mid": 0.5}).select(*keys, "_mid", F.col("n").alias("_rows"))
    middle = stage(middle, "medians")
    rows = skew_join(present, middle.drop("_rows"), keys, ["chain", "draw"], counts=middle)
    kind = lambda name, value: F.struct(F.lit(name).alias("kind"), value.alias("value"))
    both = F.inline(F.array(kind("bulk", F.col("value")), kind("tail", F.abs(F.col("value") - F.col("_mid")))))
    normal = rank_normalised(rows.select(*keys, "chain", "draw", both), [*keys, "kind"], "value")
    per_kind = split_rhat(stage(normal, "normal"), [*keys, "kind"])
    return per_kind.groupBy(*keys).agg(F.max("rhat").alias("rhat"), F.max("halves").alias("halves"))


def convergence_verdict(rhat: DataFrame, divergences: DataFrame) -> DataFrame:
    """Per panel: largest R-hat, divergences, and whether either is out of bounds."""
    worst = rhat.groupBy("panel_id").agg(F.max("rhat").alias("max_rhat"))
    return worst.join(divergences, "panel_id").withColumn(
        "converged", ~((F.col("max_rhat") > 1.01) | (F.col("divergences") > 20))
    )
