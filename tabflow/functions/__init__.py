from tabflow.functions.columns import (
    safe_ratio, row_mean, row_std, row_min, row_max, adjusted_skewness,
    adjusted_kurtosis, mean_pm_std, is_numeric, numeric_columns, string_columns, q,
)
from tabflow.functions.quantiles import exact_quantiles, quantile_columns
from tabflow.functions.lookup import apply_lookup

__all__ = [
    "safe_ratio", "row_mean", "row_std", "row_min", "row_max", "adjusted_skewness",
    "adjusted_kurtosis", "mean_pm_std", "is_numeric", "numeric_columns", "string_columns",
    "q", "exact_quantiles", "quantile_columns", "apply_lookup",
]
