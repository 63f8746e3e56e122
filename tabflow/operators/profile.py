"""Column profiling.

Design rule: one aggregate job per report.  Per-column statistics are
computed as many aggregate expressions over one scan and turned into long
form afterwards (the one-row result is tiny); per-value statistics for many
columns are computed by stacking the columns into ``(column, value)`` pairs
and grouping once, with map-side partial aggregation.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions.columns import adjusted_kurtosis, adjusted_skewness, numeric_columns, q
from tabflow.functions.lookup import counted_broadcast
from tabflow.functions.quantiles import group_quantiles, quantile_columns, ranked_values
from tabflow.functions.ranking import global_index
from tabflow.session import scratch_path

QQ_CHUNK = 65_536             # ranks of one value that a task handles at a time


def _long(row_df: DataFrame, cols, fields, common=()) -> DataFrame:
    """One-row wide aggregate ``{field}_{i}`` -> long ``(column, field...)``;
    ``common`` columns are repeated on every row."""
    structs = [F.struct(F.lit(c).alias("column"),
                        *[F.col(f"{f}_{i}").alias(f) for f in fields],
                        *[F.col(x).alias(x) for x in common]) for i, c in enumerate(cols)]
    return row_df.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def basic_info(df: DataFrame) -> DataFrame:
    """A1: ``(position, column, type, rows)``: column list with types and the
    row count (one count job)."""
    n = df.count()
    rows = [(i, f.name, f.dataType.simpleString(), n) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, rows bigint")


def type_counts(df: DataFrame) -> DataFrame:
    """A1: number of columns per type."""
    rows = {}
    for f in df.schema.fields:
        rows[f.dataType.simpleString()] = rows.get(f.dataType.simpleString(), 0) + 1
    return df.sparkSession.createDataFrame(sorted(rows.items()), "type string, n_columns bigint")


def row_digest(cols):
    """256-bit digest of a row's values; nulls equal each other and nothing else."""
    parts = []
    for c in cols:
        text = q(c).cast("string")
        parts.append(F.when(text.isNull(), F.lit("n")).otherwise(
            F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _digest_counts(df: DataFrame, cols) -> DataFrame:
    """``(digest, count)`` of repeated rows: 64 bytes a row move, not the row."""
    return df.groupBy(row_digest(cols).alias("__digest")).agg(F.count(F.lit(1)).alias("count")).where("count > 1")


def duplicate_groups(df: DataFrame, cols=None) -> DataFrame:
    """A2: groups of identical rows (nulls equal) with ``count > 1``; only rows
    of repeated digests are looked up again."""
    cols = list(cols or df.columns)
    rows = df.select(row_digest(cols).alias("__digest"), *[q(c) for c in cols])
    repeated = counted_broadcast(_digest_counts(df, cols))
    return (rows.join(repeated, "__digest").groupBy("__digest", "count").agg(*[F.first(q(c)).alias(c) for c in cols])
            .select(*[q(c) for c in cols], "count"))


def duplicate_count(df: DataFrame, cols=None) -> DataFrame:
    """A2: number of rows that repeat an earlier row (all but the first of
    each group) and number of such groups."""
    g = _digest_counts(df, list(cols or df.columns))
    return g.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"),
                 F.count(F.lit(1)).alias("n_groups"))


def missing_report(df: DataFrame, cols=None) -> DataFrame:
    """A3: ``(column, missing, percent)`` for columns with missing values,
    most missing first (one aggregate job)."""
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("n"),
                 *[F.count_if(q(c).isNull()).alias(f"missing_{i}") for i, c in enumerate(cols)])
    long = _long(agg, cols, ["missing"], common=["n"])
    return (long.where("missing > 0")
            .select("column", F.col("missing").cast("bigint").alias("missing"),
                    (F.col("missing") * 100.0 / F.col("n")).alias("percent"))
            .orderBy(F.desc("missing"), F.asc("column")))


def missing_total(df: DataFrame, cols=None) -> DataFrame:
    """A4: total missing cells."""
    cols = list(cols or df.columns)
    e = sum((F.count_if(q(c).isNull()) for c in cols), F.lit(0))
    return df.agg(e.cast("bigint").alias("missing_cells"))


def describe(df: DataFrame, cols=None) -> DataFrame:
    """A5: count, mean, sample std, min, exact 25/50/75 %, max per column.
    The moments pass also carries each column's distinct estimate, so the
    exact quantiles need one more pass (or bounded refinement passes for a
    column above the exact-map guard)."""
    cols = list(cols or numeric_columns(df))
    fields = ["count", "mean", "std", "min", "max"]
    row = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.count(q(c)).alias(f"count_{i}"), F.avg(q(c)).alias(f"mean_{i}"),
        F.stddev_samp(q(c)).alias(f"std_{i}"), F.min(q(c)).cast("double").alias(f"min_{i}"),
        F.max(q(c)).cast("double").alias(f"max_{i}"),
        F.approx_count_distinct(q(c), 0.05).alias(f"ndv_{i}"))]).first()
    qs = quantile_columns(df, cols, [0.25, 0.5, 0.75],
                          stats={c: (row[f"count_{i}"], row[f"ndv_{i}"]) for i, c in enumerate(cols)})
    spark = df.sparkSession
    rows = [(c, *[row[f"{f}_{i}"] for f in fields], *[None if v is None else float(v) for v in qs[c]])
            for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, "column string, count bigint, mean double, std double, min double, "
                                       "max double, q25 double, q50 double, q75 double").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def target_report(df: DataFrame, target: str) -> DataFrame:
    """A20 (with A6, A7): describe + adjusted skewness and kurtosis + zero and
    negative counts, one row; the moments pass carries the distinct
    estimate, so the exact quartiles need one more pass."""
    t = q(target)
    row = df.agg(F.count(t).alias("count"), F.avg(t).alias("mean"), F.stddev_samp(t).alias("std"),
                 F.min(t).cast("double").alias("min"), F.max(t).cast("double").alias("max"),
                 adjusted_skewness(t).alias("skewness"), adjusted_kurtosis(t).alias("kurtosis"),
                 F.count_if(t == 0).alias("zeros"), F.count_if(t < 0).alias("negatives"),
                 F.count_if(t.isNull()).alias("missing"), F.approx_count_distinct(t, 0.05).alias("ndv")).first()
    qs = quantile_columns(df, [target], [0.25, 0.5, 0.75], stats={target: (row["count"], row["ndv"])})[target]
    vals = (row["count"], row["mean"], row["std"], row["min"], *[None if v is None else float(v) for v in qs],
            row["max"], row["skewness"], row["kurtosis"], row["zeros"], row["negatives"], row["missing"])
    return df.sparkSession.createDataFrame([vals], (
        "count bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double, "
        "skewness double, kurtosis double, zeros bigint, negatives bigint, missing bigint"))


def stacked(df: DataFrame, cols, extra=()) -> DataFrame:
    """``(column, value[, extra...])`` pairs of several columns as strings."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), q(c).cast("string").alias("value"),
                 *[q(e).alias(e) for e in extra]) for c in cols])).alias("p")).select("p.*")


def distinct_counts(df: DataFrame, cols, approx: bool = False) -> DataFrame:
    """Distinct non-null values per column (one job); ``approx`` uses
    HyperLogLog++ (fixed memory) for very large columns."""
    f = F.approx_count_distinct if approx else F.count_distinct
    agg = df.agg(*[f(q(c)).alias(f"n_distinct_{i}") for i, c in enumerate(cols)])
    return _long(agg, cols, ["n_distinct"])


def value_counts(df: DataFrame, cols) -> DataFrame:
    """``(column, value, count)`` for several columns in one grouped job,
    nulls dropped."""
    return (stacked(df, cols).where(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count")))


def sorted_distinct(df: DataFrame, cols) -> DataFrame:
    """A10: ``(column, value, position)`` -- sorted distinct non-null values.

    Positions come from a distributed global sort of the distinct pairs
    (:func:`tabflow.functions.ranking.global_index`) minus each column's
    first index; no column's values are gathered into one task."""
    d = stacked(df, cols).where(F.col("value").isNotNull()).distinct()
    ranked = global_index(d, ["column", "value"], "gpos")
    # one row per column (bounded by the number of columns): first global index
    first = ranked.groupBy("column").agg(F.min("gpos").alias("first"))
    return (ranked.join(F.broadcast(first), "column")
            .select("column", "value", (F.col("gpos") - F.col("first")).cast("int").alias("position")))


def category_target_means(df: DataFrame, cols, target: str) -> DataFrame:
    """Target mean and count per value of every categorical, one job."""
    s = stacked(df, cols, extra=(target,)).where(F.col("value").isNotNull())
    return (s.groupBy("column", "value")
            .agg(F.avg(q(target)).alias("mean_target"), F.count(F.lit(1)).alias("count")))


def group_stats(df: DataFrame, group: str, target: str) -> DataFrame:
    """Group mean, count and sample std of the target."""
    return (df.groupBy(q(group).alias(group))
            .agg(F.avg(q(target)).alias("mean"), F.count(q(target)).alias("count"),
                 F.stddev_samp(q(target)).alias("std")))


def histogram(df: DataFrame, col: str, bins: int = 50, transform=None) -> DataFrame:
    """Equal-width bins between min and max, last bin closed; every bin
    listed (empty bins count 0).  ``transform`` e.g. ``F.log1p``.  The range
    is one small aggregate; bin ids are then literal arithmetic per row and
    one grouped count (no join of the rows with anything)."""
    x = q(col) if transform is None else transform(q(col))
    v = df.select(x.alias("x")).where(F.col("x").isNotNull())
    lo, hi = v.agg(F.min("x"), F.max("x")).first()
    spark = df.sparkSession
    ids = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    if lo is None:
        return ids.select("bin", F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper"),
                          F.lit(0).cast("bigint").alias("count"))
    width = (hi - lo) / float(bins)
    idx = (F.lit(1) if hi == lo else
           F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)) + 1)
    counts = v.select(idx.cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    return (ids.join(counts, "bin", "left")
            .select("bin", (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("lower"),
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("upper"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


MAX_GROUP_DISTINCT = 1_000_000   # exact per-group percentile map size we accept


def box_stats(df: DataFrame, col: str, group: str | None = None, whisker: float = 1.5,
              max_group_distinct: int = MAX_GROUP_DISTINCT) -> DataFrame:
    """A22 (+J5): quartiles, IQR, whiskers (furthest value inside the
    fences), number outside the fences; globally or per group.

    Quartiles are exact at any size.  Per group, ``percentile`` keeps one
    value->count map per group in one task, so it is used only while every
    group's distinct count is under ``max_group_distinct`` (estimated in one
    partial aggregate); above that the same quartiles come from the ranked
    distinct values (:func:`~tabflow.functions.quantiles.group_quantiles`).
    Rows without a group are left out, as a grouping does.  The fences are then joined back on the group key (a small table: one row
    per group) for the whisker / outlier aggregate.
    """
    x = q(col)
    spark = df.sparkSession
    if not group:
        # global: exact quartiles at any size, fences as literals, one count pass
        q1, median, q3 = [None if e is None else float(e) for e in quantile_columns(df, [col], [0.25, 0.5, 0.75])[col]]
        if q1 is None:
            row = (None,) * 6 + (None, None, 0)
        else:
            iqr = q3 - q1
            lower, upper = q1 - whisker * iqr, q3 + whisker * iqr
            inside = (x >= F.lit(lower)) & (x <= F.lit(upper))
            a = df.agg(F.min(F.when(inside, x)).cast("double"), F.max(F.when(inside, x)).cast("double"),
                       F.count_if(x.isNotNull() & ~inside)).first()
            row = (q1, median, q3, iqr, lower, upper, a[0], a[1], a[2])
        return spark.createDataFrame([row], "q1 double, median double, q3 double, iqr double, lower_fence double, "
                                            "upper_fence double, whisker_low double, whisker_high double, "
                                            "n_outliers bigint")
    df = df.where(q(group).isNotNull())
    nd = (df.groupBy(q(group).alias(group)).agg(F.approx_count_distinct(x, 0.05).alias("nd"))
          .agg(F.max("nd")).first()[0] or 0)
    probs = [0.25, 0.5, 0.75]
    if nd <= max_group_distinct:
        qs = df.groupBy(q(group).alias(group)).agg(F.percentile(x.cast("double"), F.array(*map(F.lit, probs))).alias("p"))
    else:
        qs = group_quantiles(df, col, group, probs)
    qs = qs.select(group, F.col("p")[0].alias("q1"), F.col("p")[1].alias("median"), F.col("p")[2].alias("q3"))
    qs = qs.withColumn("iqr", F.col("q3") - F.col("q1"))
    qs = (qs.withColumn("lower_fence", F.col("q1") - whisker * F.col("iqr"))
          .withColumn("upper_fence", F.col("q3") + whisker * F.col("iqr")))
    qs = counted_broadcast(qs)   # one row per group: rows are not shuffled by the group key
    j = df.select(q(group).alias(group), x.alias("__x")).join(qs, group)
    inside = (F.col("__x") >= F.col("lower_fence")) & (F.col("__x") <= F.col("upper_fence"))
    agg = j.groupBy(group).agg(
        F.min(F.when(inside, F.col("__x"))).cast("double").alias("whisker_low"),
        F.max(F.when(inside, F.col("__x"))).cast("double").alias("whisker_high"),
        F.count_if(F.col("__x").isNotNull() & ~inside).alias("n_outliers"))
    return qs.join(agg, group, "left")


def qq_table(df: DataFrame, col: str, chunk: int = QQ_CHUNK) -> DataFrame:
    """Every order statistic against the standard-normal quantile of its
    plotting position (Filliben's medians), one row per distinct value:
    ``(sample, count, first_rank, theoretical)``, ``theoretical`` the mean over
    the value's ranks, with slope, intercept and r of the line fitted on all
    order statistics.

    Values are counted and ranked on executors.  The ranks of a value are cut into chunks of ``chunk``, so that a value that
    a third of all rows has is spread over tasks; each chunk turns its ranks into normal quantiles and their sums, sums are added
    by value, and the line follows from them exactly.
    """
    ranked = ranked_values(df, col).select("value", "n", "before", "total")
    at = F.expr(f"explode(sequence(0L, (n - 1) div {int(chunk)}L))")
    chunks = ranked.select("*", at.alias("k")).select(
        "value", "n", "before", "total", (F.col("before") + F.col("k") * chunk).alias("low"),
        (F.col("before") + F.least("n", (F.col("k") + 1) * chunk)).alias("high"))
    # chunks are dealt anew: the long ones of one value lie together
    chunks = chunks.repartition("value", "low")

    def positions(batches):
        inverse = NormalDist().inv_cdf
        for batch in batches:
            total, squares = [], []
            for low, high, size in zip(*(batch.column(c).to_pylist() for c in ("low", "high", "total"))):
                t = np.array([inverse(_plotting_position(rank, size)) for rank in range(low + 1, high + 1)])
                total.append(t.sum())
                squares.append((t * t).sum())
            yield pa.RecordBatch.from_arrays([batch.column("value"), batch.column("n"), batch.column("before"), pa.array(total, pa.float64()),
                                              pa.array(squares, pa.float64())], ["sample", "count", "first_rank", "t", "t2"])

    path = scratch_path(df.sparkSession, "qq")
    sums = chunks.mapInArrow(positions, "sample double, count long, first_rank long, t double, t2 double")
    (sums.groupBy("sample", "count", "first_rank").agg(F.sum("t").alias("t"), F.sum("t2").alias("t2"))
     .withColumn("theoretical", F.col("t") / F.col("count")).write.parquet(path))
    points = df.sparkSession.read.parquet(path)
    x, c = F.col("sample"), F.col("count")
    n, sx, sxx, st, stt, sxt = points.agg(F.sum(c), F.sum(c * x), F.sum(c * x * x), F.sum("t"), F.sum("t2"), F.sum(x * F.col("t"))).first()
    slope = intercept = r = None
    if n and n > 1:
        ctt, cxx, cxt = stt - st * st / n, sxx - sx * sx / n, sxt - sx * st / n
        slope = cxt / ctt
        intercept = sx / n - slope * st / n
        r = cxt / math.sqrt(ctt * cxx) if cxx > 0 else None
    return points.select("sample", "count", "first_rank", "theoretical").withColumns(
        {k: F.lit(v).cast("double") for k, v in (("slope", slope), ("intercept", intercept), ("r", r))})


def _plotting_position(rank: int, n: int) -> float:
    """Filliben's estimate of the median of the rank-th of n uniform order statistics."""
    if rank == n:
        return 0.5 ** (1.0 / n)
    if rank == 1:
        return 1.0 - 0.5 ** (1.0 / n)
    return (rank - 0.3175) / (n + 0.365)


def scatter_bins(df: DataFrame, x: str, y: str, nx: int = 20, ny: int = 20) -> DataFrame:
    """2-D equal-width bin counts (the scatter plot's data, distributed);
    the ranges are one small aggregate, bin ids literal arithmetic per row."""
    v = df.select(q(x).alias("x"), q(y).alias("y")).dropna()
    x0, x1, y0, y1 = v.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()

    def b(c, lo, hi, n):
        if lo is None or hi == lo:
            return F.lit(1)
        return (F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit((hi - lo) / float(n))), F.lit(n - 1)) + 1).cast("int")

    return (v.select(b("x", x0, x1, nx).alias("bx"), b("y", y0, y1, ny).alias("by"))
            .groupBy("bx", "by").agg(F.count(F.lit(1)).alias("count")))


def scatter_sample(df: DataFrame, x: str, y: str, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """A seeded Bernoulli sample of complete ``(x, y)`` pairs (the
    scatter plot's points); each task samples its own rows, no shuffle."""
    return df.select(q(x).alias(x), q(y).alias(y)).dropna().sample(fraction=fraction, seed=seed)


def range_report(df: DataFrame, col: str) -> DataFrame:
    """A27."""
    return df.agg(F.min(q(col)).alias("min"), F.max(q(col)).alias("max"))
