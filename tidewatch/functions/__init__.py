"""Column expressions shared by the operators."""

from tidewatch.functions.columns import (
    as_long,
    clean,
    clock,
    clock_instant,
    clock_micros,
    floating_columns,
    instant_clock,
    is_ordinal,
    normalise_missing,
    numeric_columns,
    quoted,
)
from tidewatch.functions.stats import (
    ks_p_value,
    ks_test_p_value,
    position_percentile,
    sample_kurtosis,
    sample_skewness,
)

__all__ = [
    "as_long",
    "clean",
    "clock",
    "clock_instant",
    "clock_micros",
    "floating_columns",
    "instant_clock",
    "is_ordinal",
    "normalise_missing",
    "numeric_columns",
    "ks_p_value",
    "ks_test_p_value",
    "position_percentile",
    "quoted",
    "sample_kurtosis",
    "sample_skewness",
]
