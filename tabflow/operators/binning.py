"""Quantile and fixed-edge binning, right-closed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.functions.columns import q
from tabflow.functions.quantiles import exact_quantiles

# The reference's EDA price bins and their labels.
PRICE_EDGES = (0, 69, 136, 203, 270)
PRICE_LABELS = ("Low", "Medium", "High", "Very High")


def quantile_edges(df: DataFrame, col: str, q_bins: int = 4, max_rows: int | None = None) -> list:
    """Exact quantile edges 0, 1/q, ..., 1; duplicate edges raise (as qcut)."""
    edges = exact_quantiles(df, col, [i / q_bins for i in range(q_bins + 1)], max_rows=max_rows)
    if any(e is None for e in edges):
        raise ValueError(f"no non-null values in {col!r} to bin")
    if len(set(edges)) != len(edges):
        raise ValueError(f"Bin edges must be unique: {edges}")
    return [float(e) for e in edges]


def bin_index(col, edges, include_lowest: bool = False, labels=None):
    """0-based bin of right-closed intervals ``(e[i], e[i+1]]`` (or its label);
    the first interval includes its left edge when ``include_lowest``;
    outside -> null."""
    c = q(col) if isinstance(col, str) else col
    out = (lambda i: F.lit(labels[i])) if labels is not None else (lambda i: F.lit(i))
    first = (c >= F.lit(edges[0])) if include_lowest else (c > F.lit(edges[0]))
    expr = F.when(first & (c <= F.lit(edges[1])), out(0))
    for i in range(1, len(edges) - 1):
        expr = expr.when((c > F.lit(edges[i])) & (c <= F.lit(edges[i + 1])), out(i))
    return expr


def qcut(df: DataFrame, col: str, out: str, q_bins: int = 4, edges=None):
    """B1: quantile bin codes 0..q-1 (int).  Returns ``(df, edges)``."""
    edges = edges if edges is not None else quantile_edges(df, col, q_bins)
    return df.withColumn(out, bin_index(col, edges, include_lowest=True).cast("int")), edges


def cut(df: DataFrame, col: str, out: str, edges=PRICE_EDGES, labels=PRICE_LABELS,
        ordinal_out: str | None = None) -> DataFrame:
    """B2: fixed edges, right-closed, lowest edge excluded, outside -> null.
    Adds the label and (optionally) its ordinal so order survives storage."""
    idx = bin_index(col, list(edges), include_lowest=False)
    out_df = df.withColumn(out, bin_index(col, list(edges), include_lowest=False, labels=list(labels)))
    if ordinal_out:
        out_df = out_df.withColumn(ordinal_out, idx.cast("int"))
    return out_df


def bins_table(spark: SparkSession, edges=PRICE_EDGES, labels=PRICE_LABELS) -> DataFrame:
    """The bin dictionary ``(bin, label, lo, hi)`` -- sized by the parameters."""
    rows = [(i, labels[i], float(edges[i]), float(edges[i + 1])) for i in range(len(labels))]
    return spark.createDataFrame(rows, "bin int, label string, lo double, hi double")


def binned_profile(df: DataFrame, col: str, target: str, edges=PRICE_EDGES,
                   labels=PRICE_LABELS) -> DataFrame:
    """J4 + A12: per fixed bin of ``col``: target mean and count, every bin
    kept (empty bins: count 0, mean null).  Bin ids are computed per row, so
    the grouped aggregate is a plain hash aggregate; the 4-row bin table is
    joined after aggregation (size bounded by the parameters)."""
    spark = df.sparkSession
    idx = bin_index(col, list(edges), include_lowest=False)
    g = (df.select(idx.alias("bin"), q(target).alias("__t")).where(F.col("bin").isNotNull())
         .groupBy("bin").agg(F.avg("__t").alias("mean"), F.count("__t").alias("count")))
    return (bins_table(spark, edges, labels).join(g, "bin", "left")
            .select("bin", "label", "mean", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))
