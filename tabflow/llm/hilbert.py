"""Sharding along a Hilbert curve (operator 9).

Several metadata columns are quantised to ``BITS`` bits each and read as one
point; rows are ordered by the point's index on the Hilbert curve and the order
is cut into runs, one per shard.  Neighbours on the curve are neighbours in
every dimension, so a shard's file has narrow min/max ranges in all of them and
readers can skip files by any of the columns.  The law kept is ``rows``: shard
sizes differ by one row at most.  Strings are quantised whole, by ranges of their distinct values, so names that share a long beginning still differ.

Scale: texts are never shuffled, only (id, size, checksum, curve cell).  Cuts
come from one aggregate; cell counts are at most 2^(BITS * dimensions) rows.  A
cell that holds many rows is split by the top bits of a row hash into runs of
about ``ROWS_PER_RUN`` rows (never more than ``MAX_RUNS`` runs over all), so a
hot source is no single task; inside a run rows are numbered by a window and
the runs' offsets are added.

Defined results: nulls take the lowest cell of their dimension; a null text has
size 8 and checksum 0; repeated rows are separate rows; an empty table gives an
empty table.  Only named columns are read, others cannot clash.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabflow.functions.ranking import range_bounds, range_number
from tabflow.llm.common import stored

BITS = 5
ROWS_PER_RUN = 50_000
MAX_RUNS = 1_000_000


def hilbert_index(point: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points (rows x dimensions, ``bits`` bits each).

    Vectorised over rows: from the highest bit down, undo the rotation and
    reflection that the curve applies in the cell reached so far, then read the
    Gray code of the bits as one number.
    """
    x = point.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for d in range(dims):
            flip = (x[d] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[d] ^= swap if d else 0
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    parity = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        parity ^= np.where((x[-1] >> level) & 1, (1 << level) - 1, 0)
    x ^= parity
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            index = (index << 1) | ((x[d] >> level) & 1)
    return index


def as_number(df: DataFrame, name: str, levels: int = 2 ** BITS) -> Column:
    """A column as a double that keeps its order.  A whole string counts as the number of bounds at or below it; the bounds cut the
    distinct strings into ``levels`` ranges of about as many values (found in a hash sample of them, ``ranking.range_bounds``)."""
    if df.schema[name].dataType.simpleString() != "string":
        return F.col(name).cast("double")
    values = df.select(F.col(name).alias("value")).where("value is not null").distinct()
    n = values.count()
    bounds = range_bounds(values, ["value"], n, max(1, -(-n // levels)))
    return F.when(F.col(name).isNotNull(), range_number(df, [name], bounds)).cast("double")


def curve_cell(cuts: list[list[float]], bits: int):
    """Pandas UDF: quantise each dimension by its cuts, give the curve index."""
    @F.pandas_udf("long")
    def cell(point: pd.DataFrame) -> pd.Series:
        levels = [np.where(point.iloc[:, d].isna(), 0, np.searchsorted(c, point.iloc[:, d].fillna(0).to_numpy(), "right"))
                  for d, c in enumerate(cuts)]
        return pd.Series(hilbert_index(np.stack(levels, axis=1), bits))
    return cell


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
           dims: tuple[str, ...] = ("lang", "source", "n_chars"), bits: int = BITS,
           rows_per_run: int = ROWS_PER_RUN) -> DataFrame:
    """(id, size, text_crc32, cell, shard, slot) for every row."""
    spark = docs.sparkSession
    raw = F.col(text_col).cast("string")
    numbers = [as_number(docs, d, 2 ** bits) for d in dims]
    point = docs.select(F.col(id_col).alias("id"), (F.coalesce(F.octet_length(raw), F.lit(0)) + 8).cast("bigint").alias("size"),
                        F.crc32(F.coalesce(raw, F.lit("")).cast("binary")).alias("text_crc32"),
                        *[d.alias(f"dim{i}") for i, d in enumerate(numbers)])
    names = [f"dim{i}" for i in range(len(dims))]
    steps = [i / 2 ** bits for i in range(1, 2 ** bits)]
    found = docs.select(*[d.alias(n) for n, d in zip(names, numbers)]).agg(
        *[F.percentile_approx(n, steps, 10_000).alias(n) for n in names]).first()
    cuts = [sorted(set(found[n] or [])) for n in names]
    base = stored(point.select("id", "size", "text_crc32", curve_cell(cuts, bits)(F.struct(*names)).alias("cell"),
                               F.xxhash64("id", "text_crc32").alias("h")), "hilbert")
    cells = {r["cell"]: r["count"] for r in base.groupBy("cell").count().collect()}   # at most 2^(bits * dims) rows
    total = sum(cells.values())
    per_run = max(rows_per_run, total // MAX_RUNS)
    split = {c: max(0, math.ceil(math.log2(n / per_run))) for c, n in cells.items()}
    base = base.join(_small(spark, [(int(c), int(s)) for c, s in split.items()], "cell long, bits int"), "cell")
    base = base.withColumn("run", F.when(F.col("bits") == 0, F.lit(0)).otherwise(
        F.expr("shiftrightunsigned(h, 64 - bits)")).cast("bigint"))
    # at most cells + 2 * total / per_run rows
    runs = sorted((r["cell"], r["run"], r["count"]) for r in base.groupBy("cell", "run").count().collect())
    offsets, before = [], 0
    for cell, run, n in runs:
        offsets.append((cell, run, before))
        before += n
    order = Window.partitionBy("cell", "run").orderBy("h", "id", "text_crc32", "size")
    ranked = (base.withColumn("n", F.row_number().over(order))
              .join(_small(spark, offsets, "cell long, run long, before long"), ["cell", "run"])
              .withColumn("rank", F.col("before") + F.col("n") - 1))
    shard = F.expr(f"(rank * {shards}) div {max(total, 1)}")
    first = F.expr(f"((rank * {shards}) div {max(total, 1)} * {total} + {shards - 1}) div {shards}")
    return ranked.select(F.col("id").alias(id_col), "size", "text_crc32", "cell", shard.cast("int").alias("shard"),
                         (F.col("rank") - first).alias("slot"))


def _small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame(rows, schema))


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the rows as one folder per shard, each file sorted by slot; ids must be unique."""
    (docs.join(placed.select(id_col, "shard", "slot"), id_col).repartition("shard")
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
