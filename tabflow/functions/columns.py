"""Column-expression helpers (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

# Fixed value: the reference's guard added to ratio denominators.
RATIO_EPS = 1e-8


def q(name: str) -> Column:
    """Column by (possibly dotted or spaced) name."""
    return F.col(f"`{name}`")


def is_numeric(dt) -> bool:
    return isinstance(dt, NumericType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, StringType) and f.name not in exclude]


def safe_ratio(num, den, eps: float = RATIO_EPS) -> Column:
    """``num / (den + eps)``; ``try_divide`` so an exact zero gives null
    instead of failing the task under ANSI mode."""
    num = q(num) if isinstance(num, str) else num
    den = q(den) if isinstance(den, str) else den
    return F.try_divide(num, den + F.lit(eps))


def _arr(cols) -> Column:
    return F.array_compact(F.array(*[q(c).cast("double") if isinstance(c, str) else c.cast("double")
                                      for c in cols]))


def safe_corr(x, y) -> Column:
    """Pearson correlation that is null (not an ANSI divide-by-zero error)
    when either side is constant: ``covar_pop / (stddev_pop * stddev_pop)``
    over the rows where both are non-null (pairwise deletion, as ``corr``)."""
    x = q(x) if isinstance(x, str) else x
    y = q(y) if isinstance(y, str) else y
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(F.when(y.isNotNull(), x))
                        * F.stddev_pop(F.when(x.isNotNull(), y)))


def row_mean(cols) -> Column:
    """Null-skipping mean across columns of one row."""
    a = _arr(cols)
    s = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(a) > 0, s / F.size(a))


def row_std(cols) -> Column:
    """Null-skipping *sample* std across columns of one row."""
    a = _arr(cols)
    n = F.size(a)
    m = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x) / n
    ss = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + (x - m) * (x - m))
    return F.when(n > 1, F.sqrt(ss / (n - 1)))


def row_min(cols) -> Column:
    return F.least(*[q(c) if isinstance(c, str) else c for c in cols])


def row_max(cols) -> Column:
    return F.greatest(*[q(c) if isinstance(c, str) else c for c in cols])


def adjusted_skewness(c) -> Column:
    """Bias-adjusted sample skewness G1 = g1 * sqrt(n(n-1)) / (n-2)
    (Spark's ``skewness`` is the unadjusted g1)."""
    c = q(c) if isinstance(c, str) else c
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def adjusted_kurtosis(c) -> Column:
    """Bias-adjusted excess kurtosis
    G2 = (n-1) / ((n-2)(n-3)) * ((n+1) g2 + 6)."""
    c = q(c) if isinstance(c, str) else c
    n = F.count(c).cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6))


def mean_pm_std(mean_col, std_col, digits: int = 4) -> Column:
    """``"{mean} ± {std}"`` with fixed decimals."""
    mean_col = q(mean_col) if isinstance(mean_col, str) else mean_col
    std_col = q(std_col) if isinstance(std_col, str) else std_col
    fmt = f"%.{digits}f ± %.{digits}f"
    return F.format_string(fmt, mean_col, std_col)
