"""Batch scoring with a saved pipeline and prediction comparison."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions.columns import q, row_max, row_mean, row_min, row_std


class SelectColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The feature selector as a pipeline stage (T8): keeps the identifier
    columns and the selected features, in that order."""
    keepCols = Param(Params._dummy(), "keepCols", "columns to keep", typeConverter=TypeConverters.toListString)

    def __init__(self, keepCols=None):
        super().__init__()
        self._setDefault(keepCols=[])
        self._set(keepCols=list(keepCols or []))

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[q(c) for c in self.getOrDefault(self.keepCols) if c in df.columns])


def score(model, df: DataFrame, id_col: str, target: str, prediction_col: str = "prediction") -> DataFrame:
    """``(id, target)`` predictions; rows are scored on executors."""
    return model.transform(df).select(q(id_col), F.col(prediction_col).alias(target))


def load_and_score(path: str, df: DataFrame, id_col: str, target: str) -> DataFrame:
    """M21 from a saved ``PipelineModel`` (feature pipeline + selector + model)."""
    return score(PipelineModel.load(path), df, id_col, target)


def compare_predictions(df: DataFrame, models: dict, keep=()) -> DataFrame:
    """M22 + J7: every model's prediction side by side on the same rows
    (transforms chained, no join), with row mean / sample std / min / max.
    ``models``: ``{name: fitted model writing pred_<name>}``."""
    out = df
    for name, m in models.items():
        out = m.transform(out)
    cols = [f"pred_{n}" for n in models]
    return out.select(*[q(c) for c in keep], *[q(c) for c in cols],
                      row_mean(cols).alias("pred_mean"), row_std(cols).alias("pred_std"),
                      row_min(cols).alias("pred_min"), row_max(cols).alias("pred_max"))


def compare_stored_predictions(tables: dict, key: str, prediction_col: str = "prediction") -> DataFrame:
    """M22 + J7 for predictions that lie in tables of their own: ``(key, rows_<name>..., pred_<name>..., statistics)``, one row a key.

    All tables are grouped by key in one shuffle, however many there are, after partial sums in every task.  A key that a table
    does not have has no prediction of it (null, 0 rows) and is kept; of a key that it has several times the mean counts, with the
    number of rows beside it; null keys are one key.
    """
    names = list(tables)
    long = None
    for name in names:
        part = tables[name].select(q(key).alias(key), F.lit(name).alias("__model"), q(prediction_col).cast("double").alias("__p"))
        long = part if long is None else long.unionByName(part)
    mine = lambda n: F.col("__model") == F.lit(n)
    wide = long.groupBy(q(key).alias(key)).agg(
        *[F.count_if(mine(n)).alias(f"rows_{n}") for n in names], *[F.avg(F.when(mine(n), F.col("__p"))).alias(f"pred_{n}") for n in names])
    cols = [f"pred_{n}" for n in names]
    return wide.select("*", row_mean(cols).alias("pred_mean"), row_std(cols).alias("pred_std"), row_min(cols).alias("pred_min"), row_max(cols).alias("pred_max"))
