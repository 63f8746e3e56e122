"""Driver tables and the `sales` fixture view built over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.functions.lookup import BROADCAST_BYTES, BROADCAST_ROWS, measured_bytes
from tabflow.session import balanced, scratch_path


def load_table(spark: SparkSession, sf_dir: str, name: str, balance: bool = True) -> DataFrame:
    """One driver table; an under-partitioned scan is spread over the cores
    (see :func:`tabflow.session.balanced`) unless it is only a broadcast side."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return balanced(df) if balance else df


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retail-shaped fixture: lineitem joined to part, one row per line.

    The join is left to the optimizer: `part` grows with the scale factor, so
    it is broadcast only while its size stays under
    ``spark.sql.autoBroadcastJoinThreshold``; beyond that it is a sort-merge
    join (and AQE splits a skewed part key).
    """
    return _view(_lines(spark, sf_dir, _parts(spark, sf_dir)))


def stored_sales(spark: SparkSession, sf_dir: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The same view for a query that passes over it many times.

    The lines are joined once and written with the two columns of `part`;
    every pass reads them there, where the lazy view would send `part` through
    the driver (or shuffle `lineitem`) again.  The optimizer's threshold is
    about compressed bytes, so `part` is counted: above ``broadcast_rows`` rows
    or ``BROADCAST_BYTES`` it is shuffled and never broadcast.
    """
    part = _parts(spark, sf_dir)
    if part.count() > broadcast_rows or measured_bytes(part) > BROADCAST_BYTES:
        part = part.hint("merge")
    path = scratch_path(spark, "sales")
    _lines(spark, sf_dir, part).write.parquet(path)
    return _view(spark.read.parquet(path))


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "part", balance=False).select("p_partkey", "p_type", "p_retailprice")


def _lines(spark: SparkSession, sf_dir: str, part: DataFrame) -> DataFrame:
    """Every line with its part's type and price."""
    li = load_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_quantity", "l_discount")
    return li.join(part, li.l_partkey == part.p_partkey).drop("p_partkey")


def _view(lines: DataFrame) -> DataFrame:
    """The view's columns, all derived from a line and its part."""
    b = lines.withColumn("k", F.col("l_suppkey") % 10)
    k = F.col("k")
    price = (F.col("p_retailprice") - F.lit(900.0)) * F.lit(2.7)
    okey5 = F.col("l_orderkey") % 5
    return b.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        ((F.col("l_orderkey") * 31 + F.col("l_linenumber")) % 5).alias("fold"),
        F.when(F.col("l_orderkey") % 7 < 5, "train").otherwise("test").alias("split"),
        F.concat(F.lit("ITM"), F.col("l_partkey").cast("string")).alias("item_id"),
        F.when(F.col("l_partkey") % 6 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("l_quantity")).alias("weight"),
        F.when(okey5 == 0, "Low Fat").when(okey5 == 1, "LF").when(okey5 == 2, "low fat")
         .when(okey5 == 3, "Regular").otherwise("reg").alias("fat_content"),
        F.col("l_discount").alias("visibility"),
        F.col("p_type").alias("item_type"),
        price.alias("price"),
        F.concat(F.lit("OUT"), k.cast("string")).alias("outlet_id"),
        (F.lit(1985) + (k * 7) % 25).alias("est_year"),
        F.when(k % 4 == 1, "Small").when(k % 4 == 2, "Medium").when(k % 4 == 3, "High")
         .alias("outlet_size"),
        F.concat(F.lit("Tier "), (k % 3 + 1).cast("string")).alias("location_type"),
        F.when(k % 4 == 0, "Grocery Store").when(k % 4 == 1, "Supermarket Type1")
         .when(k % 4 == 2, "Supermarket Type2").otherwise("Supermarket Type3")
         .alias("outlet_type"),
        (F.col("l_quantity") * (F.lit(50.0) + price) * (F.lit(1.0) + k % 4) / F.lit(4.0)
         * (F.lit(1.0) - F.col("l_discount"))).alias("sales"),
    )


# The same view as SQL, inlined as a CTE by every oracle query.
SALES_SQL = """
with b as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         l_quantity, l_discount, p_type, p_retailprice, l_suppkey % 10 as k
  from lineitem join part on l_partkey = p_partkey)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  (l_orderkey * 31 + l_linenumber) % 5 as fold,
  case when l_orderkey % 7 < 5 then 'train' else 'test' end as split,
  concat('ITM', l_partkey) as item_id,
  case when l_partkey % 6 = 0 then null else l_quantity end as weight,
  case l_orderkey % 5 when 0 then 'Low Fat' when 1 then 'LF' when 2 then 'low fat'
       when 3 then 'Regular' else 'reg' end as fat_content,
  l_discount as visibility,
  p_type as item_type,
  (p_retailprice - 900e0) * 2.7e0 as price,
  concat('OUT', k) as outlet_id,
  1985 + (k * 7) % 25 as est_year,
  case k % 4 when 1 then 'Small' when 2 then 'Medium' when 3 then 'High' end as outlet_size,
  concat('Tier ', k % 3 + 1) as location_type,
  case k % 4 when 0 then 'Grocery Store' when 1 then 'Supermarket Type1'
       when 2 then 'Supermarket Type2' else 'Supermarket Type3' end as outlet_type,
  (l_quantity * (50e0 + (p_retailprice - 900e0) * 2.7e0) * (1e0 + k % 4) / 4e0
        * (1e0 - l_discount)) as sales
from b
"""
