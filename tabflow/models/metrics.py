"""M4, M5: regression metrics per fold in one aggregate, and their summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions.columns import mean_pm_std, q


def metric_exprs(label: str, prediction: str) -> list:
    """RMSE, MAE, R^2 (R^2 = 1 - SSE / (n * var_pop(y)); a constant target
    gives 1 when the fit is exact, else 0)."""
    y, p = q(label), q(prediction)
    e = y - p
    sse = F.sum(e * e)
    sst = F.var_pop(y) * F.count(y)
    return [F.count(y).alias("n"),
            F.sqrt(F.avg(e * e)).alias("rmse"),
            F.avg(F.abs(e)).alias("mae"),
            F.when(sst > 0, F.lit(1.0) - sse / sst)
             .when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("r2")]


def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction", by=()) -> DataFrame:
    """``(by..., n, rmse, mae, r2)``; partial aggregation per task, so the
    shuffle carries one row per group per task."""
    by = list(by)
    g = pred.groupBy(*[q(c).alias(c) for c in by]) if by else pred.groupBy()
    return g.agg(*metric_exprs(label, prediction))


def summarize_folds(fold_metrics: DataFrame, by=("model",)) -> DataFrame:
    """M5: mean and *population* std over folds, plus the ``mean ± std`` text."""
    by = list(by)
    out = fold_metrics.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_folds"),
        F.avg("rmse").alias("rmse_mean"), F.stddev_pop("rmse").alias("rmse_std"),
        F.avg("mae").alias("mae_mean"), F.stddev_pop("mae").alias("mae_std"),
        F.avg("r2").alias("r2_mean"), F.stddev_pop("r2").alias("r2_std"))
    return out.withColumn("rmse_text", mean_pm_std("rmse_mean", "rmse_std", 2))
