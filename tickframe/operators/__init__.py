"""Generic, key-parameterized operators built from DataFrame primitives."""

from .ordered import (  # noqa: F401
    next_values,
    prev_values,
    row_number0,
    running_sum,
)
from .sessionize import gap_sessionize  # noqa: F401
from .asof import asof_join  # noqa: F401
from .intervals import apportion_to_bins, apportion_to_bins_ranges, explode_bins  # noqa: F401
