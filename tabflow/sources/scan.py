"""Scan a train/test pair (CSV or Parquet).

In a text format the missing-value tokens that pandas' CSV reader treats as NA
become null before types are found or cast.  A typed format says itself what is
null: its strings stay as they are, only floating NaN becomes null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructType

from tabflow.functions.columns import q

# The default NA tokens of pandas' text readers.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
               "NULL", "NaN", "None", "n/a", "nan", "null")
INFERRED = ("bigint", "double", "timestamp_ntz", "boolean")


def normalize_missing(df: DataFrame, tokens=()) -> DataFrame:
    """Floating NaN -> null, and strings equal to one of ``tokens`` -> null.

    One projection, no shuffle; stays inside whole-stage codegen.
    """
    cols = []
    for f in df.schema.fields:
        c = q(f.name)
        if isinstance(f.dataType, StringType) and tokens:
            c = F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.nanvl(c, F.lit(None).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def infer_types(df: DataFrame, types=INFERRED) -> DataFrame:
    """String columns cast to the first type that every non-null value has
    (whole table, one aggregate); a column without values stays a string."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if not names:
        return df
    seen = df.agg(*[F.count(q(c)).alias(f"n{i}") for i, c in enumerate(names)],
                  *[F.count(_typed(c, t)).alias(f"{j}_{i}") for i, c in enumerate(names) for j, t in enumerate(types)]).first()
    casts = {}
    for i, c in enumerate(names):
        fits = [t for j, t in enumerate(types) if seen[f"n{i}"] and seen[f"{j}_{i}"] == seen[f"n{i}"]]
        if fits:
            casts[c] = _typed(c, fits[0])
    return df.withColumns(casts) if casts else df


def _typed(col: str, kind: str):
    """A string cast to a type, null when it is none of its spellings (``y`` or ``n`` are no booleans)."""
    cast = q(col).try_cast(kind)
    return F.when(F.lower(q(col)).isin("true", "false"), cast) if kind == "boolean" else cast


def read_table(spark: SparkSession, path: str, schema: StructType | None = None,
               fmt: str | None = None) -> DataFrame:
    """Read one table; format from the argument or the file extension.

    CSV cells are read as strings, null tokens become null, and the columns are
    cast to the declared schema or, without one, to the types that all their
    values have.
    """
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    if fmt == "csv":
        raw = spark.read.option("header", True).option("mode", "PERMISSIVE")
        if schema is not None:
            raw = raw.schema(StructType([f.__class__(f.name, StringType(), True) for f in schema.fields]))
        raw = normalize_missing(raw.csv(path), NULL_TOKENS)
        if schema is None:
            return normalize_missing(infer_types(raw))
        return normalize_missing(raw.select(*[q(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]))
    reader = spark.read.format(fmt)
    return normalize_missing((reader if schema is None else reader.schema(schema)).load(path))


def exists(spark: SparkSession, path: str) -> bool:
    """Does a path or glob of any file system name something?"""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def load_data(spark: SparkSession, train_path: str, test_path: str,
              schema: StructType | None = None, fmt: str | None = None):
    """Both splits or none: returns ``(None, None)`` if either path is missing."""
    if not (exists(spark, train_path) and exists(spark, test_path)):
        return None, None
    return (read_table(spark, train_path, schema, fmt),
            read_table(spark, test_path, schema, fmt))
