"""Query shapes that keep ordered and ranked work distributed."""

from tidewatch.plans.ordering import chunked, dense_index, over_series, row_index
from tidewatch.plans.selection import (
    before,
    exact_quantiles,
    order_statistics,
    row_positions,
)
from tidewatch.plans.staging import fresh_path, scratch, stage, staging_root

__all__ = [
    "before",
    "chunked",
    "dense_index",
    "exact_quantiles",
    "fresh_path",
    "order_statistics",
    "over_series",
    "row_index",
    "row_positions",
    "scratch",
    "stage",
    "staging_root",
]
