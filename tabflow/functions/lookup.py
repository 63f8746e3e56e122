"""Dictionary lookup.

A literal map is searched linearly per row, so only a tiny dictionary
(``LITERAL_ENTRIES``) is inlined into the projection; a larger one is a
hash join, broadcast while its *measured* rows and bytes are under a bound and
a shuffle join beyond it.  Keys are compared as strings, so a dictionary fits
an id column of any type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tabflow.functions.columns import q
from tabflow.session import scratch_path

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
LITERAL_ENTRIES = 32


def apply_lookup(df: DataFrame, key: str, mapping, out: str, n_rows: int | None = None,
                 broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add column ``out`` = mapping[key] (null when absent).

    ``mapping`` is a Python dict (small, already bounded by a count) or a
    DataFrame with columns ``(k string, v)``.
    """
    text_key = q(key).cast("string")
    if isinstance(mapping, dict):
        if not mapping:
            return df.withColumn(out, F.lit(None))
        mapping = {str(k): v for k, v in mapping.items()}
        if len(mapping) <= LITERAL_ENTRIES:
            m = F.create_map(*[F.lit(x) for kv in sorted(mapping.items()) for x in kv])
            return df.withColumn(out, F.try_element_at(m, text_key))
        vt = "int" if all(isinstance(v, int) for v in mapping.values()) else "double"
        rows = [(k, v if vt == "int" or v is None else float(v)) for k, v in mapping.items()]
        small = sum(len(k.encode()) + 16 for k in mapping) <= BROADCAST_BYTES and len(mapping) <= broadcast_rows
        mapping = df.sparkSession.createDataFrame(rows, f"k string, v {vt}")
    else:
        small = n_rows is not None and n_rows <= broadcast_rows and measured_bytes(mapping) <= BROADCAST_BYTES
    t = mapping.select(F.col("k").cast("string").alias("__lk"), F.col("v").alias("__lv"))
    if small:
        t = F.broadcast(t)
    return (df.join(t, text_key == F.col("__lk"), "left").drop("__lk")
            .withColumnRenamed("__lv", out))


def measured_bytes(df: DataFrame) -> int:
    """Bytes of a table's values: texts by their length, other columns by 16 each."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (StringType, BinaryType))]
    size = F.lit(16 * len(df.columns))
    for c in texts:
        size = size + F.coalesce(F.octet_length(q(c)), F.lit(0))
    return df.agg(F.coalesce(F.sum(size.cast("bigint")), F.lit(0)).alias("b")).first()["b"]


def counted_broadcast(small: DataFrame, bound: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A derived side table (group statistics, dictionaries) for a join back
    to the rows: it is written once to the shared scratch folder, its rows and
    bytes are measured, and it is broadcast when both are under their bounds --
    so the large side is never shuffled by a key that may hold a third of the
    rows.  Above the bounds it is left to a shuffle join (AQE splits skewed
    partitions).  Nothing stays cached."""
    path = scratch_path(small.sparkSession, "side")
    small.write.parquet(path)
    table = small.sparkSession.read.schema(small.schema).parquet(path)
    return F.broadcast(table) if table.count() <= bound and measured_bytes(table) <= max_bytes else table
