"""Derived columns and group-relative features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions.columns import q, safe_ratio
from tabflow.functions.lookup import counted_broadcast


def age(df: DataFrame, year_col: str, out: str, reference_year: int = 2013) -> DataFrame:
    """``reference_year - year``."""
    return df.withColumn(out, F.lit(reference_year) - q(year_col))


def product(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """P10."""
    return df.withColumn(out, q(a) * q(b))


def ratio(df: DataFrame, a: str, b: str, out: str, eps: float = 1e-8) -> DataFrame:
    """``a / (b + eps)``."""
    return df.withColumn(out, safe_ratio(a, b, eps))


def log1p(df: DataFrame, col: str, out: str) -> DataFrame:
    """P15."""
    return df.withColumn(out, F.log1p(q(col)))


def group_means(df: DataFrame, group_col: str, value_col: str, out: str) -> DataFrame:
    """Per-group mean table ``(group_col, out)``; nulls in the group key form
    no group (they get no mean, as in pandas)."""
    return (df.where(q(group_col).isNotNull()).groupBy(q(group_col).alias(group_col))
            .agg(F.avg(q(value_col)).alias(out)))


def attach_group_mean(df: DataFrame, group_col: str, value_col: str, out: str,
                      means: DataFrame | None = None) -> DataFrame:
    """The group mean broadcast back to each row.

    Written as grouped aggregate + join instead of ``avg().over(partitionBy)``:
    the aggregate is partial per task, so a hot key holding a third of the rows
    costs one row per task rather than one giant window partition.  The
    means table is counted and broadcast below a bound, so the rows are
    never shuffled by the (possibly skewed) group key; above it, a shuffle
    join with AQE skew splitting.  Column order of ``df`` is kept.
    """
    m = means if means is not None else group_means(df, group_col, value_col, out)
    m = counted_broadcast(m.select(q(group_col).alias("__g"), q(out).alias("__m")))
    return (df.join(m, q(group_col) == F.col("__g"), "left").drop("__g")
            .withColumnRenamed("__m", out))


def ratio_to_group_mean(df: DataFrame, value_col: str, mean_col: str, out: str,
                        eps: float = 1e-8) -> DataFrame:
    """Row value / (its group mean + eps)."""
    return df.withColumn(out, safe_ratio(value_col, mean_col, eps))
