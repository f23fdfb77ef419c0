"""Least squares for many panels at once, design matrices, contributions and ROI."""

from __future__ import annotations

import functools
import math
import sys
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fourier_terms, hill_saturation, safe_ratio
from .carryover import adstock_geometric
from .panel import panel_window, series_window, trend_term
from .segments import SEGMENT, segmented_lag

# Task functions travel by value, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEASON = ["season_0", "season_1", "season_2", "season_3"]
CONTROLS = [*SEASON, "trend", "competitor"]


# ------------------------------------------------------------------ moments and solve


def moments(df: DataFrame, key: str, xs: list[str], y: str) -> DataFrame:
    """One row per key: row count, means and co-moments of ``xs`` and ``y``, all in one aggregate.

    Covariances are merged pairwise around running means, so large competitor values next to a
    constant do not cancel.
    """
    cols = [*xs, y]
    return df.groupBy(key).agg(
        F.count("*").alias("n"),
        F.array(*[F.avg(c) for c in cols]).alias("means"),
        F.array(
            *[F.covar_pop(a, b) for a, b in combinations_with_replacement(cols, 2)]
        ).alias("covs"),
    )


def gram_long(df: DataFrame, key: str, xs: list[str], y: str) -> DataFrame:
    """(key, row_term, col_term, covariance): the moments as rows, upper triangle."""
    pairs = list(combinations_with_replacement([*xs, y], 2))
    structs = [
        F.struct(
            F.lit(a).alias("row_term"), F.lit(b).alias("col_term"),
            F.col("covs")[i].alias("covariance"),
        )
        for i, (a, b) in enumerate(pairs)
    ]
    return moments(df, key, xs, y).select(key, F.inline(F.array(*structs)))


def _beta_fraction(x: np.ndarray, a: float, b: float) -> np.ndarray:
    """Continued fraction of the incomplete beta function by the modified Lentz method."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    value = d.copy()
    for m in range(1, 500):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + step * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + step / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            value = value * d * c
        if np.all(np.abs(d * c - 1) < 1e-15):
            break
    return value


def student_two_sided(t: np.ndarray, dof: float) -> np.ndarray:
    """P(|T| > t): the regularised incomplete beta function I(dof/2, 1/2) at dof / (dof + t^2).

    The cost does not depend on the degrees of freedom; from 10^7 on T is normal to 8 digits.
    """
    t = np.asarray(t, dtype=float)
    if dof >= 1e7:
        return np.vectorize(math.erfc, otypes=[float])(np.abs(t) / math.sqrt(2))
    a, b = dof / 2, 0.5
    x, y = dof / (dof + t * t), t * t / (dof + t * t)
    front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    with np.errstate(divide="ignore", invalid="ignore"):
        weight = np.exp(front + a * np.log(x) + b * np.log(y))
        low = weight * _beta_fraction(np.minimum(x, (a + 1) / (a + b + 2)), a, b) / a
        high = 1 - weight * _beta_fraction(np.minimum(y, (b + 1) / (a + b + 2)), b, a) / b
    return np.where(t == 0, 1.0, np.where(np.isnan(t), np.nan, np.clip(np.where(x < (a + 1) / (a + b + 2), low, high), 0.0, 1.0)))


@functools.lru_cache(maxsize=1024)
def student_quantile(p_two_sided: float, dof: float) -> float:
    """t with P(|T| > t) = p, by Newton steps inside a shrinking bracket."""
    lo, hi = 0.0, 1.0
    while student_two_sided(np.array(hi), dof) > p_two_sided:
        lo, hi = hi, 2 * hi
    front = math.lgamma((min(dof, 1e7) + 1) / 2) - math.lgamma(min(dof, 1e7) / 2) - 0.5 * math.log(min(dof, 1e7) * math.pi)
    t = (lo + hi) / 2
    for _ in range(60):
        gap = float(student_two_sided(np.array(t), dof)) - p_two_sided
        lo, hi = (t, hi) if gap > 0 else (lo, t)
        density = math.exp(front - (min(dof, 1e7) + 1) / 2 * math.log1p(t * t / min(dof, 1e7)))
        move = t + gap / (2 * density)
        move = move if lo < move < hi else (lo + hi) / 2
        if abs(move - t) < 1e-13 * t:
            break
        t = move
    return t


#: Triangular factors that are merged together.
FAN = 64
#: Singular values of the scaled terms below this share of the largest count as zero.
RANK = 1e-11


def _stacked(parts: list[np.ndarray]) -> np.ndarray:
    """The triangular factor of rows, or of factors, on top of each other."""
    rows = np.vstack(parts)
    if len(rows) < rows.shape[1]:  # a square factor whatever the number of rows
        rows = np.vstack([rows, np.zeros((rows.shape[1] - len(rows), rows.shape[1]))])
    return np.linalg.qr(rows, mode="r")


def triangular_factors(df: DataFrame, key: str, xs: list[str], y: str) -> DataFrame:
    """(key, n, r): row count and the factor R of the QR decomposition of [1, xs, y], one row per key.

    Every task reduces the rows it holds to one factor for each key, in blocks as they arrive; the
    factors of a key, (k+2)^2 numbers each, are merged in a tree of groups of ``FAN`` tasks. The
    rows themselves are never squared and never shuffled.
    """
    width = len(xs) + 2
    key_type = df.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, part int, n bigint, r array<double>"

    def reduce_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        held: dict = {}
        flush = lambda: pd.DataFrame(
            [(k, part, n, r.ravel()) for k, (n, r) in held.items()], columns=[key, "part", "n", "r"]
        )
        for batch in batches:
            batch = batch.dropna(subset=[*xs, y])
            for value, rows in batch.groupby(key, dropna=False, sort=False):
                value = None if pd.isna(value) else value
                block = np.column_stack([np.ones(len(rows)), rows[[*xs, y]].to_numpy(dtype=float)])
                n, r = held.get(value, (0, np.zeros((0, width))))
                held[value] = (n + len(rows), _stacked([r, block]))
            if len(held) > 10_000:  # a task may see very many keys
                yield flush()
                held.clear()
        if held:
            yield flush()

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            factors = [_stacked([np.asarray(r).reshape(-1, width) for r in rs]).ravel() for rs in batch["rs"]]
            yield pd.DataFrame({key: batch[key], "part": batch["part"], "n": batch["n"], "r": factors})

    partial = df.select(key, *[F.col(c).cast("double").alias(c) for c in (*xs, y)]).mapInPandas(reduce_rows, schema)
    for part in (F.floor(F.col("part") / FAN).cast("int"), F.lit(0)):
        grouped = partial.groupBy(key, part.alias("part")).agg(F.sum("n").alias("n"), F.collect_list("r").alias("rs"))
        partial = grouped.mapInPandas(merge, schema)
    return partial.select(key, "n", "r")


def ols_fit(df: DataFrame, key: str, xs: list[str], y: str) -> DataFrame:
    """(key, term, coef, std_error, t_value, p_value, ci_lo, ci_hi, n, r2, adj_r2, aic, bic, sse).

    Solved from the triangular factor of the rows, so a condition number of the terms costs half the
    digits that it would through sums of squares. Rows with a null term or ``y`` are left out. Terms
    without variance get coefficient 0 and no error. AIC, BIC and degrees of freedom count the rank
    of the terms, so collinear ones count once, and not the error variance.
    """

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            frames = [_solve_one(int(r.n), np.asarray(r.r).reshape(len(xs) + 2, -1), xs) for r in batch.itertuples()]
            for value, frame in zip(batch[key], frames):
                frame.insert(0, key, value)
            if frames:
                yield pd.concat(frames, ignore_index=True)

    key_type = df.schema[key].dataType.simpleString()
    schema = (
        f"{key} {key_type}, term string, coef double, std_error double, t_value double, "
        "p_value double, ci_lo double, ci_hi double, n bigint, r2 double, adj_r2 double, "
        "aic double, bic double, sse double"
    )
    return triangular_factors(df, key, xs, y).mapInPandas(solve, schema)


def _solve_one(n: int, r: np.ndarray, xs: list[str]) -> pd.DataFrame:
    """The fit from R of [1, xs, y]: below its first row stands the factor of the centred columns."""
    k = len(xs) + 1
    mean = r[0, 1:] / r[0, 0]
    centred, target, rest = r[1:k, 1:k], r[1:k, k], r[k, k]
    scale = np.linalg.norm(centred, axis=0)
    live = np.flatnonzero(scale > 1e-12 * np.abs(r[0, 1:k]))
    u, sv, vt = np.linalg.svd(centred[:, live] / scale[live], full_matrices=False)
    ok = sv > RANK * sv.max(initial=0.0)
    half_inv = vt[ok].T / sv[ok]
    b = np.zeros(k - 1)
    b[live] = half_inv @ (u[:, ok].T @ target) / scale[live]
    inv = half_inv @ half_inv.T / np.outer(scale[live], scale[live])
    const = mean[-1] - b @ mean[:-1]
    sst = float(target @ target + rest**2)
    miss = target - centred @ b
    sse = float(miss @ miss + rest**2)
    params = int(ok.sum()) + 1
    dof = n - params
    s2 = sse / dof if dof > 0 else np.nan
    var = np.full(k, np.nan)
    var[0] = s2 * (1 / n + mean[:-1][live] @ inv @ mean[:-1][live])
    var[live + 1] = s2 * np.diag(inv)
    coef, err = np.concatenate([[const], b]), np.sqrt(var)
    with np.errstate(divide="ignore", invalid="ignore"):
        t = coef / err
    p = student_two_sided(t, dof) if dof > 0 else np.full(k, np.nan)
    half = student_quantile(0.05, dof) * err if dof > 0 else np.full(k, np.nan)
    r2 = 1 - sse / sst if sst > 0 else np.nan
    log_lik = -n / 2 * (math.log(2 * math.pi * sse / n) + 1) if sse > 0 else np.inf
    return pd.DataFrame(
        {
            "term": ["const", *xs],
            "coef": coef, "std_error": err, "t_value": t, "p_value": p,
            "ci_lo": coef - half, "ci_hi": coef + half, "n": int(n), "r2": r2,
            "adj_r2": 1 - (1 - r2) * (n - 1) / dof if dof > 0 else np.nan,
            "aic": 2 * params - 2 * log_lik, "bic": math.log(n) * params - 2 * log_lik, "sse": sse,
        }
    )


def residuals(df: DataFrame, fit: DataFrame, key: str, xs: list[str], y: str) -> DataFrame:
    """``df`` with ``fitted`` and ``residual`` under the coefficients that ``ols_fit`` gave its key.

    The coefficients meet the rows as one map per key; rows whose key has no fit are left out.
    """
    coefs = fit.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("term", "coef"))).alias("_coefs"))
    fitted = sum((F.col("_coefs")[x] * F.col(x) for x in xs), F.col("_coefs")["const"])
    out = df.join(coefs, key).withColumn("fitted", fitted)
    return out.withColumn("residual", F.col(y) - F.col("fitted")).drop("_coefs")


def significant(p_value: Column, level: float = 0.05) -> Column:
    return p_value < level


# ------------------------------------------------------------------ fit quality


def fit_stats(residuals: DataFrame, params: int, segment: int = SEGMENT) -> DataFrame:
    """Per panel, from rows (panel_id, t, actual, residual): R2, adjusted R2, AIC, BIC,
    Durbin-Watson and lag-1 correlation of the residuals. ``t`` counts up without gaps; a task
    holds ``segment`` steps of a panel."""
    e, prev = F.col("residual"), F.col("_prev")
    summed = (
        segmented_lag(residuals, ["panel_id"], "t", "residual", "_prev", segment)
        .groupBy("panel_id")
        .agg(
            F.count("*").alias("n"),
            F.sum(e * e).alias("sse"),
            (F.var_pop("actual") * F.count("*")).alias("sst"),
            F.sum((e - prev) * (e - prev)).alias("step"),
            F.corr(F.when(prev.isNotNull(), e), prev).alias("lag1_corr"),
        )
    )
    n, sse = F.col("n"), F.col("sse")
    r2 = 1 - F.try_divide(sse, F.col("sst"))
    fit = n * (F.log(2 * math.pi * sse / n) + 1)
    return summed.select(
        "panel_id",
        "n",
        r2.alias("r2"),
        (1 - (1 - r2) * F.try_divide(n - 1, n - params)).alias("adj_r2"),
        (fit + 2 * params).alias("aic"),
        (fit + F.log(n) * params).alias("bic"),
        F.try_divide(F.col("step"), sse).alias("durbin_watson"),
        "lag1_corr",
    )


# ------------------------------------------------------------------ media-mix design


def mmm_design(panel: DataFrame, params: DataFrame, channels: list[str]) -> DataFrame:
    """One row per (panel, week): Hill-saturated adstock per channel, season, trend, competitor,
    and revenue.

    Every cell carries its share of revenue and competitor sales through the adstock step, so the
    fact scan is read once: one shuffle by series, one by (panel, week).
    """
    stocked = adstock_geometric(panel, params)
    k = F.col("k_pct") * F.max("adstock").over(series_window())
    sat = hill_saturation(F.col("adstock"), F.col("alpha"), k)
    wide = (
        stocked.withColumn("sat", sat)
        .groupBy("panel_id", "week", "t", "n_weeks")
        .agg(
            *[
                F.coalesce(F.max(F.when(F.col("channel") == c, F.col("sat"))), F.lit(0.0)).alias(c)
                for c in channels
            ],
            F.sum("revenue").alias("revenue"),
            F.sum("competitor").alias("competitor"),
            F.sum("spend").alias("spend"),
            *[
                F.coalesce(F.sum(F.when(F.col("channel") == c, F.col("spend"))), F.lit(0.0)).alias(
                    f"spend_{c}"
                )
                for c in channels
            ],
        )
    )
    top = F.max("competitor").over(panel_window())
    return wide.select(
        "panel_id",
        "week",
        "t",
        "revenue",
        *channels,
        *fourier_terms(F.col("t")),
        trend_term().alias("trend"),
        safe_ratio(F.col("competitor"), top).alias("competitor"),
        *[f"spend_{c}" for c in channels],
    )


def long_design(design: DataFrame, channels: list[str]) -> DataFrame:
    """(panel_id, week, t, revenue, term, x, spend): one row per term, ``const`` with x = 1."""
    terms = [("const", F.lit(1.0), F.lit(0.0))]
    terms += [(c, F.col(c), F.col(f"spend_{c}")) for c in channels]
    terms += [(c, F.col(c), F.lit(0.0)) for c in CONTROLS]
    rows = F.array(
        *[F.struct(F.lit(n).alias("term"), x.alias("x"), s.alias("spend")) for n, x, s in terms]
    )
    return design.select("panel_id", "week", "t", "revenue", F.inline(rows))


def contributions(
    design: DataFrame, coefs: DataFrame, channels: list[str], on: list[str] | None = None
) -> DataFrame:
    """(panel_id, week, t, component, contribution, spend, revenue): one row per channel and one
    ``base`` row (constant, season, trend, competitor) per week.

    ``coefs`` is (term, coef), or (panel_id, term, coef) with ``on=['panel_id', 'term']``.
    """
    component = F.when(F.col("term").isin(channels), F.col("term")).otherwise(F.lit("base"))
    return (
        long_design(design, channels)
        .join(coefs, on or ["term"])
        .groupBy("panel_id", "week", "t", component.alias("component"))
        .agg(
            F.sum(F.col("coef") * F.col("x")).alias("contribution"),
            F.sum("spend").alias("spend"),
            F.max("revenue").alias("revenue"),
        )
    )


def channel_roi(contribs: DataFrame) -> DataFrame:
    """Total contribution over total spend per channel, 0 without spend."""
    return (
        contribs.where(F.col("component") != "base")
        .groupBy("panel_id", F.col("component").alias("channel"))
        .agg(F.sum("contribution").alias("contribution"), F.sum("spend").alias("spend"))
        .withColumn("roi", safe_ratio(F.col("contribution"), F.col("spend")))
    )


def base_share(contribs: DataFrame) -> DataFrame:
    base = F.col("component") == "base"
    return contribs.groupBy("panel_id").agg(
        (
            F.try_divide(
                F.sum(F.when(base, F.col("contribution"))), F.sum(F.when(base, F.col("revenue")))
            )
            * 100
        ).alias("base_pct")
    )


def fitted_residuals(contribs: DataFrame) -> DataFrame:
    """(panel_id, week, t, actual, fitted, residual)."""
    return contribs.groupBy("panel_id", "week", "t").agg(
        F.max("revenue").alias("actual"),
        F.sum("contribution").alias("fitted"),
        (F.max("revenue") - F.sum("contribution")).alias("residual"),
    )


def decomposition_stack(contribs: DataFrame, order: list[str]) -> DataFrame:
    """Running sum over the components of a week in a fixed order: lower and upper edge."""
    pos = F.array_position(F.array(*[F.lit(c) for c in order]), F.col("component"))
    placed = contribs.withColumn("pos", pos.cast("int"))
    w = Window.partitionBy("panel_id", "week").orderBy("pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    upper = F.sum("contribution").over(w)
    return placed.select(
        "panel_id", "week", "component", "pos",
        (upper - F.col("contribution")).alias("lower_edge"),
        upper.alias("upper_edge"),
    )


def saturation_curve(panel: DataFrame, params: DataFrame, points: int = 200) -> DataFrame:
    """Hill response of each series on ``points`` equal steps from 0 to its largest adstock."""
    top = (
        adstock_geometric(panel, params, keep=["spend"])
        .groupBy("panel_id", "channel", "alpha", "k_pct")
        .agg(F.max("adstock").alias("top"))
    )
    grid = top.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("step"))
    share = F.col("step") / (points - 1)
    return grid.select(
        "panel_id",
        "channel",
        "step",
        (share * F.col("top")).alias("adstock"),
        hill_saturation(share * F.col("top"), F.col("alpha"), F.col("k_pct") * F.col("top")).alias(
            "response"
        ),
    )
