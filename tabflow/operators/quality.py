"""Data-quality checks, each one aggregate pass (plus the exact
quartile passes where fences are needed)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions.columns import adjusted_skewness, numeric_columns, q
from tabflow.functions.quantiles import quantile_columns
from tabflow.operators.profile import _long, duplicate_count
from tabflow.roles import Roles

INF = float("inf")


def _fences(df: DataFrame, cols, whisker: float = 1.5) -> dict:
    qs = quantile_columns(df, cols, [0.25, 0.75])
    out = {}
    for c in cols:
        q1, q3 = qs[c]
        if q1 is None:
            out[c] = (None, None, None, None)
            continue
        iqr = q3 - q1
        out[c] = (q1, q3, q1 - whisker * iqr, q3 + whisker * iqr)
    return out


def _outside(c: str, fences) -> F.Column:
    _q1, _q3, lo, hi = fences
    if lo is None:
        return F.lit(False)
    return (q(c) < F.lit(lo)) | (q(c) > F.lit(hi))


def iqr_outliers(df: DataFrame, cols=None, exclude=()) -> DataFrame:
    """``(column, q1, q3, lower, upper, n_outliers)`` for numeric columns;
    fences from exact quartiles, all counts in one aggregate."""
    cols = list(cols or numeric_columns(df, exclude=exclude))
    fences = _fences(df, cols)
    agg = df.agg(*[F.count_if(_outside(c, fences[c])).alias(f"n_outliers_{i}") for i, c in enumerate(cols)])
    spark = df.sparkSession
    fdf = spark.createDataFrame([(c, *[None if v is None else float(v) for v in fences[c]]) for c in cols],
                                "column string, q1 double, q3 double, lower double, upper double")
    return fdf.join(_long(agg, cols, ["n_outliers"]), "column")


def numeric_counts(df: DataFrame, cols=None) -> DataFrame:
    """A16 + A17 + zero counts: ``(column, n_infinite, n_negative, n_zero)``."""
    cols = list(cols or numeric_columns(df))
    aggs = []
    for i, c in enumerate(cols):
        x = q(c)
        aggs += [F.count_if((x == F.lit(INF)) | (x == F.lit(-INF))).alias(f"n_infinite_{i}"),
                 F.count_if(x < 0).alias(f"n_negative_{i}"), F.count_if(x == 0).alias(f"n_zero_{i}")]
    return _long(df.agg(*aggs), cols, ["n_infinite", "n_negative", "n_zero"])


def quality_findings(df: DataFrame, r: Roles = Roles()) -> DataFrame:
    """Long findings table ``(check, column, n, severity)`` with n > 0:
    inconsistent labels, impossible zero visibility, zero values and IQR
    outliers of numeric columns (target skipped; zero check also skips the
    year column)."""
    has = set(df.columns)
    num = numeric_columns(df, exclude=(r.target,))
    fences = _fences(df, num)
    specs = []   # (check, column, expr, severity)
    if r.fat in has:
        bad = [k for k, _ in r.fat_mapping]
        specs.append(("inconsistent_labels", r.fat, q(r.fat).isin(*bad), "issue"))
    if r.visibility in has:
        specs.append(("impossible_zeros", r.visibility, q(r.visibility) == 0, "issue"))
    for c in num:
        if c != r.year:
            specs.append(("zero_values", c, q(c) == 0, "note"))
        specs.append(("outliers", c, _outside(c, fences[c]), "note"))
    agg = df.agg(*[F.count_if(e).alias(f"n_{i}") for i, (_, _, e, _) in enumerate(specs)])
    structs = [F.struct(F.lit(ch).alias("check"), F.lit(c).alias("column"),
                        F.col(f"n_{i}").alias("n"), F.lit(sev).alias("severity"))
               for i, (ch, c, _, sev) in enumerate(specs)]
    return (agg.select(F.explode(F.array(*structs)).alias("s")).select("s.*").where("n > 0"))


def validate_preprocessing(original: DataFrame, processed: DataFrame, target: str) -> DataFrame:
    """``(check, subject, n)`` -- missing cells before/after, infinite
    cells after, column count per type after, unexpected negatives after."""
    spark = processed.sparkSession
    num = numeric_columns(processed)
    o = original.agg(sum((F.count_if(q(c).isNull()) for c in original.columns), F.lit(0))
                     .cast("bigint").alias("m")).first()["m"]
    aggs = [sum((F.count_if(q(c).isNull()) for c in processed.columns), F.lit(0)).cast("bigint").alias("m"),
            sum((F.count_if(q(c).isin(F.lit(INF), F.lit(-INF))) for c in num), F.lit(0))
            .cast("bigint").alias("inf")]
    neg = [c for c in num if c != target]
    aggs += [F.count_if(q(c) < 0).alias(f"neg_{i}") for i, c in enumerate(neg)]
    p = processed.agg(*aggs).first()
    rows = [("missing_total", "original", o), ("missing_total", "processed", p["m"]),
            ("infinite_total", "processed", p["inf"])]
    types = {}
    for f in processed.schema.fields:
        types[f.dataType.simpleString()] = types.get(f.dataType.simpleString(), 0) + 1
    rows += [("columns_of_type", t, n) for t, n in sorted(types.items())]
    rows += [("negative_values", c, p[f"neg_{i}"]) for i, c in enumerate(neg) if p[f"neg_{i}"] > 0]
    return spark.createDataFrame(rows, "check string, subject string, n bigint")


def quality_report(df: DataFrame, target: str | None = None) -> DataFrame:
    """One-row report: shape, missing cells, duplicate rows, numeric
    columns, infinite cells, and a target block.  Two jobs (one aggregate,
    one duplicate count)."""
    num = numeric_columns(df)
    aggs = [F.count(F.lit(1)).alias("rows"),
            sum((F.count_if(q(c).isNull()) for c in df.columns), F.lit(0)).cast("bigint").alias("missing_cells"),
            sum((F.count_if(q(c).isin(F.lit(INF), F.lit(-INF))) for c in num), F.lit(0))
            .cast("bigint").alias("infinite_cells")]
    if target and target in df.columns:
        t = q(target)
        aggs += [F.count_if(t.isNull()).alias("target_missing"), F.count_if(t == 0).alias("target_zeros"),
                 F.count_if(t < 0).alias("target_negatives"), F.avg(t).alias("target_mean"),
                 F.stddev_samp(t).alias("target_std"), adjusted_skewness(t).alias("target_skewness")]
    n_dup = duplicate_count(df).first()["n_duplicates"]
    return (df.agg(*aggs).withColumn("n_duplicates", F.lit(n_dup).cast("bigint"))
            .withColumn("columns", F.lit(len(df.columns)))
            .withColumn("numeric_columns", F.lit(len(num))))


def column_quality(df: DataFrame) -> DataFrame:
    """A19, per column: ``(column, missing, infinite)`` of every column, one aggregate."""
    num = set(numeric_columns(df))
    none = F.lit(0).cast("bigint")
    cells = df.agg(*[F.count_if(q(c).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)],
                   *[(F.count_if(q(c).isin(F.lit(INF), F.lit(-INF))) if c in num else F.sum(none)).alias(f"i{i}")
                     for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing"), F.coalesce(F.col(f"i{i}"), none).alias("infinite"))
                     for i, c in enumerate(df.columns)])
    return cells.select(F.explode(rows).alias("r")).select("r.*")
