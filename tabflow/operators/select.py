"""A25, A26, FS1-FS4: correlation and univariate F-score feature selection."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions.columns import numeric_columns, q, safe_corr
from tabflow.operators.encode import category_codes
from tabflow.operators.profile import _long

MAX_F = sys.float_info.max


def target_correlations(df: DataFrame, target: str, cols=None) -> DataFrame:
    """``(feature, correlation, abs_correlation)`` of every numeric
    feature with the target (pairwise null drop), strongest first; one job."""
    cols = [c for c in (cols or numeric_columns(df)) if c != target]
    agg = df.agg(*[safe_corr(q(c).cast("double"), q(target).cast("double")).alias(f"correlation_{i}")
                   for i, c in enumerate(cols)])
    return (_long(agg, cols, ["correlation"]).withColumnRenamed("column", "feature")
            .withColumn("abs_correlation", F.abs("correlation"))
            .orderBy(F.desc_nulls_last("abs_correlation"), "feature"))


def correlation_matrix(df: DataFrame, cols) -> DataFrame:
    """All pairwise Pearson correlations ``(a, b, correlation)`` in one
    aggregate (n(n-1)/2 cells computed once, mirrored)."""
    cols = list(cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    agg = df.agg(*[(F.lit(1.0) if i == j else safe_corr(q(cols[i]).cast("double"), q(cols[j]).cast("double")))
                   .alias(f"c_{i}_{j}") for i, j in pairs])
    structs = []
    for i, j in pairs:
        structs.append(F.struct(F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b"),
                                F.col(f"c_{i}_{j}").alias("correlation")))
        if i != j:
            structs.append(F.struct(F.lit(cols[j]).alias("a"), F.lit(cols[i]).alias("b"),
                                    F.col(f"c_{i}_{j}").alias("correlation")))
    return agg.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def f_scores(df: DataFrame, target: str, cols=None) -> DataFrame:
    """FS1: univariate regression F = r^2 / (1 - r^2) * (n - 2) per feature,
    n = rows where both are non-null.  Constant feature -> 0; r^2 = 1 ->
    largest double (finite, as the reference's scorer reports)."""
    cols = [c for c in (cols or numeric_columns(df)) if c != target]
    y = q(target).cast("double")
    aggs = []
    for i, c in enumerate(cols):
        x = q(c).cast("double")
        aggs += [safe_corr(x, y).alias(f"corr_{i}"),
                 F.count_if(x.isNotNull() & y.isNotNull()).alias(f"n_{i}")]
    long = _long(df.agg(*aggs), cols, ["corr", "n"]).withColumnRenamed("column", "feature")
    r2 = F.col("corr") * F.col("corr")
    f = (F.when(F.col("corr").isNull(), F.lit(0.0))
         .when(r2 >= 1.0, F.lit(MAX_F))
         .otherwise(r2 / (F.lit(1.0) - r2) * (F.col("n") - 2)))
    pos = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
    return long.select("feature", F.try_element_at(pos, F.col("feature")).alias("position"),
                       F.col("corr").alias("correlation"), F.col("n").cast("bigint").alias("n"),
                       f.alias("f_score"))


def select_k_best(df: DataFrame, target: str, k: int = 15, cols=None):
    """FS2: ``(scores, selected)`` -- the score table ranked by F (desc,
    position asc) with ``rank`` and ``selected``; ``selected`` is the list of
    the k best names in their original column order (k = min(k, n))."""
    from pyspark.sql import Window as W
    s = f_scores(df, target, cols)
    # the score table has one row per feature: materialize it once, so the
    # selected names and the returned ranking do not each rescan the data
    s = df.sparkSession.createDataFrame(s.collect(), s.schema)
    # scores equal up to rounding noise (e.g. perfectly collinear features)
    # tie, and ties go to the earlier column; the window sorts one row per
    # feature (bounded by the number of columns)
    key = F.round(F.col("f_score") * F.lit(1e6), 0) / F.lit(1e6)
    ranked = s.withColumn("rank", F.row_number().over(
        W.orderBy(key.desc(), F.asc("position"))).cast("int"))
    ranked = ranked.withColumn("selected", F.col("rank") <= F.lit(k))
    names = [r["feature"] for r in ranked.where("selected").orderBy("position").collect()]
    return ranked, names


def analyze_and_select(df: DataFrame, target: str, k: int = 15, cols=None) -> DataFrame:
    """FS3: ``(feature, position, abs_correlation, f_score, rank, selected)``
    -- correlation and F-score from the same single aggregate."""
    ranked, _names = select_k_best(df, target, k, cols)
    return ranked.select("feature", "position", F.abs("correlation").alias("abs_correlation"),
                         "f_score", "rank", "selected")


def prepare_modeling_data(df: DataFrame, target: str, exclude=()):
    """FS4 (P1, P19, P3): drop identifiers and target, code string columns
    (E2: sorted values, null -> -1), keep numeric columns only.
    Returns ``(features_df_with_target, feature_names)``."""
    ex = set(exclude) | {target}
    feats = [c for c in df.columns if c not in ex]
    coded = category_codes(df.select(*[q(c) for c in feats + [target] if c in df.columns]),
                           [f.name for f in df.schema.fields
                            if f.name in feats and f.dataType.simpleString() == "string"])
    names = numeric_columns(coded.select(*[q(c) for c in feats]))
    return coded.select(*[q(c) for c in names + [target]]), names


def fold_f_scores(df: DataFrame, target: str, fold_col: str, k: int, cols=None) -> DataFrame:
    """FS2 inside the folds (no leak): ``(fold, feature, correlation, n, f_score, rank, selected)`` of every training fold, from one
    pass over the rows: a training fold's moments are all rows' less the fold's.  Nulls fail with their count."""
    from tabflow.models.linear import fold_moments, moment_scores
    cols = [c for c in (cols or numeric_columns(df)) if c not in (target, fold_col)]
    per_fold, _ = fold_moments(df, cols, target, fold_col)
    rows = []
    if per_fold:
        total = sum(list(per_fold.values())[1:], list(per_fold.values())[0])
        for f, m in sorted(per_fold.items()):
            r, scores, chosen = moment_scores(total - m, k)
            order = sorted(range(len(cols)), key=lambda i: (-round(scores[i], 6), i))
            rows += [(f, cols[i], float(r[i]), int((total - m).n), float(scores[i]), place + 1, i in chosen) for place, i in enumerate(order)]
    return df.sparkSession.createDataFrame(rows, "fold int, feature string, correlation double, n bigint, f_score double, rank int, selected boolean")
