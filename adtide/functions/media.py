"""Saturation, seasonality and small decision rules as Spark columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the weekly model.
YEAR_WEEKS = 52.18
HARMONICS = 2
MAX_LAG = 8


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den``, 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def clip(x: Column, lo: float | Column, hi: float | Column) -> Column:
    return F.least(F.greatest(x, _col(lo)), _col(hi))


def hill_saturation(x: Column, alpha: Column | float, k: Column | float) -> Column:
    """``x^alpha / (x^alpha + k^alpha)`` on ``max(x, 0)``; 0.5 at ``x = k``, 0 where x = k = 0."""
    xa = F.pow(F.greatest(x, F.lit(0.0)), _col(alpha))
    return safe_ratio(xa, xa + F.pow(_col(k), _col(alpha)))


def exponential_saturation(x: Column, k: Column | float) -> Column:
    """``1 - exp(-x/k)``; expm1 keeps the digits of small x."""
    return -F.expm1(-x / _col(k))


def fourier_terms(
    t: Column, period: float = YEAR_WEEKS, harmonics: int = HARMONICS
) -> list[Column]:
    """``season_0, season_1, ...`` = sin, cos of harmonic 1, then sin, cos of harmonic 2, ..."""
    out: list[Column] = []
    for h in range(1, harmonics + 1):
        angle = F.lit(2 * math.pi * h) * t / F.lit(period)
        out += [F.sin(angle), F.cos(angle)]
    return [c.alias(f"season_{i}") for i, c in enumerate(out)]


def lag_weights(decay: Column, max_lag: int = MAX_LAG) -> list[Column]:
    """Geometric weights ``decay^l`` for l = 0..max_lag-1, scaled to sum to 1."""
    raw = [F.pow(decay, F.lit(float(lag))) for lag in range(max_lag)]
    total = sum(raw[1:], raw[0])
    return [w / total for w in raw]


def change_marker(m: Column) -> Column:
    """``up`` / ``down`` when the multiplier moved by more than 2 percent, else ``equal``."""
    return F.when(m > 1.02, F.lit("up")).when(m < 0.98, F.lit("down")).otherwise(F.lit("equal"))


def scenario_verdict(selected: Column, current: Column, mean_uplift: Column) -> Column:
    """Budget drift above 5 percent is a warning; otherwise the sign of the mean uplift decides."""
    drift = F.abs(safe_ratio(selected - current, current))
    return (
        F.when(drift > 0.05, F.lit("warning"))
        .when(mean_uplift > 0, F.lit("improves"))
        .otherwise(F.lit("no_gain"))
    )


def _col(x: Column | float) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))
