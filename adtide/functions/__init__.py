"""Column expressions: every formula is defined once here and shared by operators and tests."""

from .media import (  # noqa: F401
    clip,
    change_marker,
    exponential_saturation,
    fourier_terms,
    hill_saturation,
    lag_weights,
    safe_ratio,
    scenario_verdict,
)
from .hashing import md5_bucket  # noqa: F401
