"""Scalar column expressions (all built-in Spark functions, codegen-friendly)."""

from covlens.functions.exprs import (  # noqa: F401
    as_col, day_from_int, entity_bucket, exact_mean, is_weekend, mean_from_scaled, null_flag,
    pair_label, pct, period, period_of_date, period_of_int, ratio, scaled_sum, slice_floor,
    slice_from_file_name, starts_with,
)
