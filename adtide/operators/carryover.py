"""Carry-over of advertising: recursive adstock, lag vectors, normalised adstock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lag_weights
from ..functions.media import MAX_LAG
from .panel import series_window

BLOCK = 64


def recursive_sum(xs: Column, decay: Column, block: int = BLOCK) -> Column:
    """``a_t = x_t + decay * a_{t-1}`` over an array.

    The array is cut into blocks. Each block is summed from zero, then the value at the end of the
    previous blocks is carried in with the weight ``decay^(offset+1)``. Only non-negative powers
    appear, so no decay overflows, and the work grows with length x block, not length squared.
    """
    starts = F.sequence(F.lit(0), F.ceil(F.size(xs) / block).cast("int") - 1)

    def within(points: Column) -> Column:
        return F.aggregate(
            points,
            F.array().cast("array<double>"),
            lambda acc, x: F.concat(
                acc, F.array(x + decay * F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)))
            ),
        )

    local = F.transform(starts, lambda b: within(F.slice(xs, b * block + 1, F.lit(block))))
    carry = F.aggregate(
        local,
        F.array(F.lit(0.0)),
        lambda acc, part: F.concat(
            acc,
            F.array(
                F.element_at(part, -1)
                + F.pow(decay, F.lit(float(block))) * F.element_at(acc, -1)
            ),
        ),
    )
    pair = F.struct(local.alias("local"), carry.alias("carry"))

    def join_blocks(p: Column) -> Column:
        return F.flatten(
            F.transform(
                p["local"],
                lambda part, b: F.transform(
                    part, lambda v, o: v + F.pow(decay, o + 1) * F.get(p["carry"], b)
                ),
            )
        )

    return F.element_at(F.transform(F.array(pair), join_blocks), 1)


def adstock_geometric(panel: DataFrame, params: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Recursive adstock of every series, unbounded memory, not normalised.

    One shuffle by series. Adds ``adstock`` and the parameter columns; ``keep`` names the columns
    carried through (default all).
    """
    cols = keep or [c for c in panel.columns if c not in ("panel_id", "channel")]
    cols = ["t", *[c for c in cols if c != "t"]]
    extra = [c for c in params.columns if c != "channel"]
    packed = panel.groupBy("panel_id", "channel").agg(
        F.sort_array(F.collect_list(F.struct(*cols))).alias("points")
    )
    summed = packed.join(params, "channel").withColumn(
        "adstocks", recursive_sum(F.col("points.spend"), F.col("decay"))
    )
    return summed.select(
        "panel_id", "channel", *extra, F.explode(F.arrays_zip("points", "adstocks")).alias("z")
    ).select(
        "panel_id",
        "channel",
        *extra,
        *[F.col(f"z.points.{c}").alias(c) for c in cols],
        F.col("z.adstocks").alias("adstock"),
    )


def lag_columns(x: str, max_lag: int = MAX_LAG) -> list[Column]:
    """``lag_0 .. lag_{max_lag-1}`` of ``x`` by t within the series, 0 before the start."""
    order = series_window().orderBy("t")
    return [F.lag(x, lag, 0.0).over(order).alias(f"lag_{lag}") for lag in range(max_lag)]


def weighted_lags(weights: list[Column], xs: Column, t: Column) -> Column:
    """``sum_l weights[l] * xs[t-l]`` with zeros before the start of the array."""
    terms = [w * F.coalesce(F.get(xs, (t - i).cast("int")), F.lit(0.0)) for i, w in enumerate(weights)]
    return sum(terms[1:], terms[0])


def adstock_normalized(panel: DataFrame, params: DataFrame, max_lag: int = MAX_LAG) -> DataFrame:
    """Weighted mean of the last ``max_lag`` weeks with weights decay^l; early weeks are not
    renormalised. Adds ``adstock``."""
    lagged = panel.select("*", *lag_columns("spend", max_lag)).join(params, "channel")
    terms = [w * F.col(f"lag_{i}") for i, w in enumerate(lag_weights(F.col("decay"), max_lag))]
    return lagged.withColumn("adstock", sum(terms[1:], terms[0])).drop(
        *[f"lag_{i}" for i in range(max_lag)]
    )
