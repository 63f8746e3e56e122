"""Ordinal dictionaries and category codes.

A dictionary maps the sorted distinct values of a column to 0..n-1.  All
columns' value counts come from one scan (the columns are stacked into
``(column, value)`` pairs and partially aggregated per task).  A dictionary
that is small by count is held as a Python dict and applied as a literal map
inside the projection; a large one is ranked on executors (ranges cut by
literal bounds, :mod:`tabflow.functions.ranking`), written once so its codes
are stable on recompute, and applied by join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions.columns import q
from tabflow.functions.lookup import apply_lookup
from tabflow.functions.ranking import global_index
from tabflow.session import scratch_path

LITERAL_LIMIT = 20_000


@dataclass
class Dictionary:
    size: int
    values: list | None = None        # sorted values when small
    table: DataFrame | None = None    # (k string, v int) when large

    def mapping(self):
        if self.values is not None:
            return {v: i for i, v in enumerate(self.values)}
        return self.table


def stacked_value_counts(df: DataFrame, cols) -> DataFrame:
    """``(column, value, count)`` for several string columns in one pass;
    null values are kept as their own row."""
    cols = list(cols)
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), q(c).cast("string").alias("value")) for c in cols
    ])).alias("p")).select("p.*")
    return pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def _rank_table(values: DataFrame) -> DataFrame:
    """Distributed ordinal codes for a large set of distinct values ``(value)``,
    written to the shared scratch folder so the codes are fixed once fitted."""
    ranked = global_index(values.select(F.col("value").cast("string").alias("k")), ["k"], "v")
    path = scratch_path(values.sparkSession, "codes")
    ranked.select("k", F.col("v").cast("int").alias("v")).write.parquet(path)
    return values.sparkSession.read.schema("k string, v int").parquet(path)


def dictionaries_from_values(distinct: DataFrame, cols, literal_limit: int = LITERAL_LIMIT) -> dict:
    """``distinct(column, value)`` (no nulls) -> ``{column: Dictionary}``.

    The distinct pairs are persisted for the duration of the fit so the
    scan runs once; only dictionaries under ``literal_limit`` (by count) are
    collected, sorted by code point (= Spark's binary string order).
    """
    distinct = (distinct.where(F.col("value").isNotNull()).select("column", "value")
                .distinct().persist())
    try:
        sizes = {r["column"]: r["count"] for r in distinct.groupBy("column").count().collect()}
        small = [c for c in cols if sizes.get(c, 0) <= literal_limit]
        vals = {c: [] for c in small}
        if small:
            for r in distinct.where(F.col("column").isin(*small)).collect():
                vals[r["column"]].append(r["value"])
        out = {}
        for c in cols:
            if c in vals:
                out[c] = Dictionary(size=len(vals[c]), values=sorted(vals[c]))
            else:
                out[c] = Dictionary(size=sizes[c], table=_rank_table(
                    distinct.where(F.col("column") == c).select("value")))
        return out
    finally:
        distinct.unpersist()


def fit_dictionaries(df: DataFrame, cols, missing_token: str | None = "Missing",
                     literal_limit: int = LITERAL_LIMIT) -> dict:
    """E1 fit: sorted distinct values per column (nulls -> ``missing_token``,
    or dropped when it is None)."""
    vc = stacked_value_counts(df, cols)
    v = F.col("value")
    if missing_token is not None:
        vc = vc.withColumn("value", F.coalesce(v, F.lit(missing_token)))
    return dictionaries_from_values(vc, cols, literal_limit)


def encode(df: DataFrame, col: str, dictionary: Dictionary, out: str | None = None,
           unknown: str = "error", null_code: int | None = None,
           missing_token: str | None = None) -> DataFrame:
    """Replace ``col`` by its int code.

    ``missing_token``: nulls are filled with it first (E1).  ``null_code``:
    code for nulls left after that (E2 uses -1).  ``unknown``: ``error``
    (task fails with a clear message), ``keep`` (code = dictionary size),
    ``missing`` (-1).
    """
    out = out or col
    tmp = "__code"
    src = q(col) if missing_token is None else F.coalesce(q(col), F.lit(missing_token))
    d = df.withColumn("__key", src.cast("string"))
    d = apply_lookup(d, "__key", dictionary.mapping(), tmp, n_rows=dictionary.size)
    code, key = F.col(tmp), F.col("__key")
    if unknown == "error":
        unk = F.raise_error(F.concat(F.lit(f"unknown category in {col}: "), key))
    elif unknown == "keep":
        unk = F.lit(dictionary.size)
    elif unknown == "missing":
        unk = F.lit(-1)
    else:
        raise ValueError(f"unknown policy {unknown!r}")
    null_val = F.lit(null_code) if null_code is not None else F.lit(None)
    expr = (F.when(key.isNull(), null_val).when(code.isNull(), unk).otherwise(code)).cast("int")
    cols = [expr.alias(out) if c == col and out == col else q(c) for c in df.columns]
    if out != col:
        cols.append(expr.alias(out))
    return d.select(*cols)


def label_encode(df: DataFrame, cols, dictionaries: dict | None = None,
                 missing_token: str = "Missing", unknown: str = "error"):
    """Fitted ordinal encoding of several columns; returns ``(df, dicts)``."""
    cols = [c for c in cols if c in df.columns]
    dictionaries = dictionaries or fit_dictionaries(df, cols, missing_token)
    for c in cols:
        df = encode(df, c, dictionaries[c], unknown=unknown, missing_token=missing_token)
    return df, dictionaries


def category_codes(df: DataFrame, cols) -> DataFrame:
    """Codes refitted on this frame; sorted non-null values -> 0..n-1,
    null -> -1."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    dicts = fit_dictionaries(df, cols, missing_token=None)
    for c in cols:
        df = encode(df, c, dicts[c], unknown="missing", null_code=-1)
    return df


def dictionaries_frame(spark, dictionaries: dict) -> DataFrame:
    """Long form ``(column, value, code)`` of fitted dictionaries (small ones
    from their counted value lists, large ones from their ranked tables)."""
    small = [(c, v, i) for c, d in dictionaries.items() if d.values is not None
             for i, v in enumerate(d.values)]
    out = spark.createDataFrame(small, "column string, value string, code int")
    for c, d in dictionaries.items():
        if d.values is None:
            out = out.unionByName(d.table.select(F.lit(c).alias("column"), F.col("k").alias("value"),
                                                 F.col("v").alias("code")))
    return out
