"""Helpers shared by registered queries and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tabflow.sources.tables import SALES_SQL


def round_scaled(c, digits: int = 6):
    """``round(x * 10^d) / 10^d`` on the binary value.  ``F.round`` rounds the
    shortest decimal string half-up, which breaks some ties differently from
    engines that scale first (DuckDB), so comparison forms use this."""
    m = float(10 ** digits)
    return F.round(c * F.lit(m), 0) / F.lit(m)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (comparison form of a result)."""
    return df.select(*[round_scaled(F.col(f"`{f.name}`"), digits).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def with_sales(body: str) -> str:
    """Prefix an oracle with the fixture view as a CTE named ``sales``."""
    return f"with sales as ({SALES_SQL})\n{body}"



def bigint_counts(sql: str) -> str:
    """Rewrite ``count_if(expr)`` as ``(count(*) filter (where expr))``: the
    same count, typed BIGINT in DuckDB (``count_if`` is HUGEINT there),
    matching Spark's ``count_if`` (bigint)."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        k, depth = j + len(key), 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = bigint_counts(sql[j + len(key):k - 1])
        out.append(f"(count(*) filter (where {inner}))")
        i = k
