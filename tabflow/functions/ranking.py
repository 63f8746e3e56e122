"""Global 0-based positions in a sort order, JVM-side.

The order is cut into ranges by literal bounds, fixed once from a small sample
of the keys.  Every key finds its range by comparing with the bounds, one
grouped count gives the rows per range, and inside a range rows are numbered by
a window; a range's offset is a literal.  No partition id is used, so the
positions do not depend on how a shuffle is planned, coalesced or repeated.
The ordering columns must have no ties (distinct values) and no nulls.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.functions.columns import q

ROWS_PER_RANGE = 250_000
MAX_RANGES = 1024
SAMPLED_PER_RANGE = 20


def range_bounds(df: DataFrame, order_cols, n_rows: int, rows_per_range: int = ROWS_PER_RANGE) -> list[tuple]:
    """Ascending keys that cut the order into ranges of about ``rows_per_range`` rows."""
    wanted = min(MAX_RANGES, -(-n_rows // rows_per_range))
    if wanted < 2:
        return []
    keys = df.select(*[q(c) for c in order_cols])
    every = max(1, n_rows // (wanted * SAMPLED_PER_RANGE))
    # a hash picks the sample: about wanted * SAMPLED_PER_RANGE keys, the same on every run
    sample = keys.where(F.pmod(F.xxhash64(*order_cols), F.lit(every)) == 0).orderBy(*order_cols).collect()
    picked = [tuple(sample[len(sample) * i // wanted]) for i in range(1, wanted)] if sample else []
    return list(dict.fromkeys(picked))


def range_number(df: DataFrame, order_cols, bounds: list[tuple]) -> Column:
    """How many bounds lie at or below a row's key (binary search in nested comparisons)."""
    types = [df.schema[c].dataType for c in order_cols]
    key = F.struct(*[q(c).alias(f"k{i}") for i, c in enumerate(order_cols)])
    edges = [F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(b, types))]) for b in bounds]

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(key < edges[mid], search(low, mid)).otherwise(search(mid + 1, high))

    return search(0, len(edges))


def global_index(df: DataFrame, order_cols, out: str = "idx", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``df`` with its rows' positions in the order of ``order_cols``."""
    order_cols, cols = list(order_cols), list(df.columns)
    bounds = range_bounds(df, order_cols, df.count(), rows_per_range)
    placed = df.withColumn("__range", range_number(df, order_cols, bounds))
    sizes = {r["__range"]: r["count"] for r in placed.groupBy("__range").count().collect()}   # at most MAX_RANGES rows
    starts = [0, *accumulate(sizes.get(i, 0) for i in range(len(bounds)))]
    window = Window.partitionBy("__range").orderBy(*[q(c) for c in order_cols])
    start = F.element_at(F.array(*[F.lit(s).cast("bigint") for s in starts]), F.col("__range") + 1)
    return (placed.withColumn("__place", F.row_number().over(window))
            .select(*[q(c) for c in cols], (start + F.col("__place") - 1).alias(out)))
