"""Imputation, standardization, zero repair, unknown categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions.columns import q
from tabflow.functions.lookup import counted_broadcast


def fit_mean(df: DataFrame, cols) -> dict:
    """Means of several columns in one aggregate (nulls ignored)."""
    cols = list(cols)
    if not cols:
        return {}
    row = df.agg(*[F.avg(q(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return {c: row[f"m{i}"] for i, c in enumerate(cols)}


def impute_mean(df: DataFrame, cols, means: dict | None = None):
    """Fill nulls with the (given or fitted) mean; returns ``(df, means)``."""
    means = means if means is not None else fit_mean(df, cols)
    out = df
    for c in cols:
        if c in df.columns and means.get(c) is not None:
            out = out.withColumn(c, F.coalesce(q(c), F.lit(float(means[c]))))
    return out, means


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``(value, count)``; nulls dropped, count desc then value asc.
    Partial (map-side) aggregation makes a hot value cost one row per task."""
    return (df.where(q(col).isNotNull()).groupBy(q(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc("value")))


def fit_mode(df: DataFrame, col: str, fallback=None):
    """P5: most frequent non-null value, smallest value on ties, ``fallback``
    when the column is all null.  Distributed: grouped count + top-1."""
    row = value_counts(df, col).limit(1).collect()
    return row[0]["value"] if row else fallback


def impute_mode(df: DataFrame, col: str, mode=None, fallback=None):
    mode = mode if mode is not None else fit_mode(df, col, fallback)
    if col not in df.columns or mode is None:
        return df, mode
    return df.withColumn(col, F.coalesce(q(col), F.lit(mode))), mode


def fill_constant(df: DataFrame, cols, token: str = "Missing") -> DataFrame:
    """Constant fill of string columns."""
    cols = [c for c in cols if c in df.columns]
    return df.fillna(token, subset=cols) if cols else df


def mapping_expr(c, mapping):
    """CASE expression replacing dictionary keys by values, others unchanged."""
    expr = None
    for k, v in dict(mapping).items():
        expr = (F.when(c == F.lit(k), F.lit(v)) if expr is None
                else expr.when(c == F.lit(k), F.lit(v)))
    return c if expr is None else expr.otherwise(c)


def standardize_values(df: DataFrame, col: str, mapping) -> DataFrame:
    """Replace values by a dictionary; other values unchanged.

    A small mapping is a CASE expression in the projection (no shuffle, no join).
    """
    if col not in df.columns or not dict(mapping):
        return df
    return df.withColumn(col, mapping_expr(q(col), mapping))


def standardization_counts(df: DataFrame, col: str, mapping) -> DataFrame:
    """P7 report: value counts before and after standardization in one scan
    and one grouped aggregate: ``(value, before, after)``."""
    c = q(col)
    pairs = df.select(F.explode(F.array(
        F.struct(c.alias("value"), F.lit(True).alias("is_before")),
        F.struct(mapping_expr(c, mapping).alias("value"), F.lit(False).alias("is_before")),
    )).alias("p")).select("p.*")
    return (pairs.where(F.col("value").isNotNull()).groupBy("value")
            .agg(F.count_if(F.col("is_before")).cast("bigint").alias("before"),
                 F.count_if(~F.col("is_before")).cast("bigint").alias("after")))


def fit_positive_mean(df: DataFrame, col: str):
    return df.agg(F.avg(F.when(q(col) > 0, q(col))).alias("m")).first()["m"]


def repair_zeros(df: DataFrame, col: str, mean=None):
    """Exact zeros -> mean of the strictly positive values; a no-op when
    there are no zeros.  Returns ``(df, mean)``."""
    mean = mean if mean is not None else fit_positive_mean(df, col)
    if col not in df.columns:
        return df, mean
    fill = F.lit(None).cast("double") if mean is None else F.lit(float(mean))
    return df.withColumn(col, F.when(q(col) == 0, fill).otherwise(q(col))), mean


def drop_null_rows(df: DataFrame, subset=None) -> DataFrame:
    """P13."""
    return df.dropna(subset=list(subset) if subset else None)


def replace_unknown(df: DataFrame, col: str, known: DataFrame | list, token: str = "Missing",
                    known_col: str = "value") -> DataFrame:
    """Values not in the known set -> ``token`` (nulls stay null).

    A list becomes an IN-set in the projection; a DataFrame dictionary is a
    left join, broadcast when its counted size is under the bound.
    """
    c = q(col)
    if isinstance(known, (list, tuple, set)):
        return df.withColumn(col, F.when(c.isNull() | c.isin(*list(known)), c).otherwise(F.lit(token)))
    k = counted_broadcast(known.select(F.col(known_col).alias("__known")).distinct())
    j = df.join(k, c == F.col("__known"), "left")
    return j.withColumn(col, F.when(c.isNull() | F.col("__known").isNotNull(), c)
                        .otherwise(F.lit(token))).drop("__known")


def unknown_values(df: DataFrame, col: str, known: DataFrame, known_col: str = "value") -> DataFrame:
    """Distinct values of ``col`` absent from the dictionary (anti join)."""
    seen = df.select(q(col).alias("value")).where(F.col("value").isNotNull()).distinct()
    return seen.join(counted_broadcast(known.select(F.col(known_col).alias("value")).distinct()), "value", "left_anti")
