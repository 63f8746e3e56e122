"""Exact quantiles (linear interpolation, as ``percentile`` / ``quantile_cont``)
with bounded memory at any scale.

Spark's exact ``percentile`` keeps one value->count map of all distinct values
in a single final buffer.  That is fine while the distinct count is bounded,
so it is used below a guard.  Above the guard the order statistics are found
by bracket refinement: every pass runs one distributed aggregate that narrows
each rank's value range with ``approx_percentile`` and verifies it with exact
counts, until a bracket holds few enough distinct values to walk.  The result
is exact; only bounded brackets ever reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabflow.functions.columns import q
from tabflow.functions.ranking import ROWS_PER_RANGE, range_bounds, range_number
from tabflow.session import scratch_path

MAX_EXACT_DISTINCT = 1_000_000   # percentile() map size we accept in one buffer
MAX_COLLECT = 100_000            # distinct values of a bracket walked on the driver
ACCURACY = 10_000


def _interp(vals: dict, n: int, p: float) -> float:
    pos = (n - 1) * p
    lo, hi = math.floor(pos), math.ceil(pos)
    if lo == hi:
        return vals[lo]
    return (hi - pos) * vals[lo] + (pos - lo) * vals[hi]


def _in(x, lo, hi):
    c = F.lit(True)
    if lo is not None:
        c = c & (x >= F.lit(lo))
    if hi is not None:
        c = c & (x <= F.lit(hi))
    return c


def select_ranks_multi(df: DataFrame, targets: dict, max_collect: int = MAX_COLLECT,
                       accuracy: int = ACCURACY) -> dict:
    """Exact order statistics for several columns at once.

    ``targets``: ``{column: (n non-null rows, [0-based ranks])}``; returns
    ``{column: {rank: value}}``.  Every (column, rank) keeps an inclusive
    value bracket with the number of rows below and inside it.  Each round
    runs at most three aggregate jobs for *all* columns together: one
    stacked grouped count reads the brackets that are small enough to walk
    (their sizes summed stay under ``max_collect``), one ``percentile_approx``
    job proposes narrower brackets for the rest, one ``count_if`` job
    verifies them.  A proposal that misses its rank or does not shrink its
    bracket is widened for the next round, and the bracket is split at a value
    inside it, so every bracket loses at least one distinct value per round.
    """
    xs = {c: q(c).cast("double") for c in targets}
    br = {(c, r): [None, None, 0, n] for c, (n, ranks) in targets.items() for r in ranks}
    mult = {k: 2.0 for k in br}
    out = {c: {} for c in targets}
    while True:
        todo = [k for k in br if k[1] not in out[k[0]]]
        if not todo:
            return out
        # walk the smallest brackets first while their summed size stays under max_collect
        small, budget = [], max_collect
        for k in sorted(todo, key=lambda k: br[k][3]):
            if br[k][3] <= budget:
                small.append(k)
                budget -= br[k][3]
        if small:
            cols = sorted({c for c, _ in small})
            items = []
            for c in cols:
                cond = F.lit(False)
                for k in small:
                    if k[0] == c:
                        cond = cond | _in(xs[c], br[k][0], br[k][1])
                items.append(F.struct(F.lit(c).alias("c"), F.when(cond, xs[c]).alias("v")))
            rows = (df.select(F.explode(F.array(*items)).alias("p")).select("p.*")
                    .where(F.col("v").isNotNull()).groupBy("c", "v").count().collect())
            by_col = {}
            for row in rows:
                by_col.setdefault(row["c"], []).append((row["v"], row["count"]))
            for c in by_col:
                by_col[c].sort()
            for k in small:
                c, r = k
                lo, hi, below, _m = br[k]
                cum = below
                for v, cnt in by_col.get(c, []):
                    if (lo is not None and v < lo) or (hi is not None and v > hi):
                        continue
                    if r < cum + cnt:
                        out[c][r] = v
                        break
                    cum += cnt
        big = [k for k in todo if k[1] not in out[k[0]] and k not in small]
        if not big:
            continue
        aggs = []
        for i, k in enumerate(big):
            lo, hi, below, m = br[k]
            t = k[1] - below
            slack = mult[k] * m / accuracy + 1
            f_lo = max(0.0, (t - slack) / max(m - 1, 1))
            f_hi = min(1.0, (t + slack) / max(m - 1, 1))
            x = xs[k[0]]
            aggs.append(F.percentile_approx(F.when(_in(x, lo, hi), x), [f_lo, f_hi], accuracy).alias(f"b{i}"))
        bounds = df.agg(*aggs).first()
        cnts = []
        for i, k in enumerate(big):
            a, b = bounds[f"b{i}"]
            x = xs[k[0]]
            cnts += [F.count_if(x < F.lit(a)).alias(f"lt{i}"),
                     F.count_if((x >= F.lit(a)) & (x <= F.lit(b))).alias(f"in{i}")]
        cr = df.agg(*cnts).first()
        stuck = []
        for i, k in enumerate(big):
            a, b = bounds[f"b{i}"]
            below, m = cr[f"lt{i}"], cr[f"in{i}"]
            if below <= k[1] < below + m and m < br[k][3]:
                if a == b:
                    out[k[0]][k[1]] = a
                br[k] = [a, b, below, m]
            else:
                mult[k] *= 4
                stuck.append((k, a, b))
        # a bracket that did not shrink loses at least one value: split it at the proposed lower bound,
        # which lies inside it; its rank is below, at or above that value
        if stuck:
            aggs = []
            for i, (k, a, b) in enumerate(stuck):
                lo, hi, _below, _m = br[k]
                x, inside = xs[k[0]], _in(xs[k[0]], lo, hi)
                pivot = F.lit(a)
                aggs += [F.count_if(inside & (x < pivot)).alias(f"lt{i}"), F.count_if(x == pivot).alias(f"eq{i}"),
                         F.max(F.when(inside & (x < pivot), x)).alias(f"prev{i}"),
                         F.min(F.when(inside & (x > pivot), x)).alias(f"next{i}")]
            row = df.agg(*aggs).first()
            for i, (k, a, b) in enumerate(stuck):
                lo, hi, below, m = br[k]
                lt, eq, r = row[f"lt{i}"], row[f"eq{i}"], k[1] - below
                if r < lt:
                    br[k] = [lo, row[f"prev{i}"], below, lt]
                elif r < lt + eq:
                    out[k[0]][k[1]] = a
                else:
                    br[k] = [row[f"next{i}"], hi, below + lt + eq, m - lt - eq]


def select_ranks(values: DataFrame, n: int, ranks, max_collect: int = MAX_COLLECT,
                 accuracy: int = ACCURACY) -> dict:
    """Exact order statistics (0-based ranks among non-null ``x``) of a
    one-column DataFrame ``values(x double)`` with ``n`` non-null rows."""
    return select_ranks_multi(values, {"x": (n, list(ranks))}, max_collect, accuracy)["x"]


def exact_quantiles(df: DataFrame, col: str, probs, max_exact_distinct: int = MAX_EXACT_DISTINCT,
                    max_collect: int = MAX_COLLECT, max_rows: int | None = None) -> list:
    """Exact interpolated quantiles of one column; nulls ignored."""
    return quantile_columns(df, [col], probs, max_exact_distinct, max_collect, max_rows)[col]


def quantile_columns(df: DataFrame, cols, probs, max_exact_distinct: int = MAX_EXACT_DISTINCT,
                     max_collect: int = MAX_COLLECT, max_rows: int | None = None,
                     stats: dict | None = None) -> dict:
    """Exact quantiles for several columns: one pass for counts and distinct
    estimates, one pass for all columns under the guard, refinement for the rest.

    ``max_rows``: a known bound on the row count (e.g. from an aggregate the
    caller already ran); when it is under the guard no column can exceed it,
    so the estimate pass is skipped.  ``stats``: ``{col: (non-null count,
    distinct estimate)}`` from the caller's own aggregate, same effect.
    """
    probs = [float(p) for p in probs]
    cols = list(cols)
    if not cols:
        return {}
    if max_rows is not None and max_rows <= max_exact_distinct:
        parr = F.array(*[F.lit(p) for p in probs])
        row = df.agg(*[F.percentile(q(c).cast("double"), parr).alias(f"p{i}") for i, c in enumerate(cols)]).first()
        return {c: (list(row[f"p{i}"]) if row[f"p{i}"] is not None else [None] * len(probs))
                for i, c in enumerate(cols)}
    if stats is not None and all(c in stats for c in cols):
        pre = {**{f"n{i}": stats[c][0] for i, c in enumerate(cols)},
               **{f"d{i}": stats[c][1] for i, c in enumerate(cols)}}
    else:
        pre = df.agg(*[F.count(q(c)).alias(f"n{i}") for i, c in enumerate(cols)],
                     *[F.approx_count_distinct(q(c), 0.05).alias(f"d{i}") for i, c in enumerate(cols)]
                     ).first()
    res = {}
    cheap = [i for i, _ in enumerate(cols) if pre[f"d{i}"] <= max_exact_distinct]
    if cheap:
        parr = F.array(*[F.lit(p) for p in probs])
        row = df.agg(*[F.percentile(q(cols[i]).cast("double"), parr).alias(f"p{i}")
                       for i in cheap]).first()
        for i in cheap:
            v = row[f"p{i}"]
            res[cols[i]] = list(v) if v is not None else [None] * len(probs)
    targets = {}
    for i, c in enumerate(cols):
        if i in cheap:
            continue
        n = pre[f"n{i}"]
        if n == 0:
            res[c] = [None] * len(probs)
            continue
        targets[c] = (n, sorted({k for p in probs for k in (math.floor((n - 1) * p), math.ceil((n - 1) * p))}))
    if targets:
        # all columns above the guard share the refinement rounds
        vals = select_ranks_multi(df.select(*[q(c) for c in targets]), targets, max_collect)
        for c, (n, _ranks) in targets.items():
            res[c] = [_interp(vals[c], n, p) for p in probs]
    return res


def ranked_values(df: DataFrame, col: str, group: str | None = None,
                  rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``(g, value, n, before, total)``: every distinct value of a group with
    its count, the rows of the group below it and the rows of the group.

    Equal values are counted before anything moves; the (group, value) order is
    cut into ranges by literal bounds, so a group of any size is counted by many
    tasks; a group's rows in earlier ranges are one row per (group, range).
    Null values and null groups are left out.
    """
    spark = df.sparkSession
    g = q(group) if group else F.lit(0)
    path = scratch_path(spark, "values")
    (df.select(g.alias("g"), q(col).cast("double").alias("value")).where("g is not null and value is not null")
     .groupBy("g", "value").agg(F.count(F.lit(1)).alias("n")).write.parquet(path))
    values = spark.read.parquet(path)
    bounds = range_bounds(values, ["g", "value"], values.count(), rows_per_range)
    placed = values.withColumn("range", range_number(values, ["g", "value"], bounds))
    parts = placed.groupBy("g", "range").agg(F.sum("n").alias("part"))
    earlier = Window.partitionBy("g").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("g", "range", F.coalesce(F.sum("part").over(earlier), F.lit(0)).alias("start"),
                         F.sum("part").over(Window.partitionBy("g")).alias("total"))
    inside = Window.partitionBy("g", "range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    return (placed.withColumn("lower", F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .join(parts, ["g", "range"])
            .select("g", "value", "n", (F.col("start") + F.col("lower")).alias("before"), "total"))


def group_quantiles(df: DataFrame, col: str, group: str, probs, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``(group, p)``: exact interpolated quantiles of every group, whatever its
    size, from the ranked distinct values; nothing of a group is held in one buffer."""
    ranked = ranked_values(df, col, group, rows_per_range)
    here = lambda rank: (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))
    aggs, values = [], []
    for i, p in enumerate(probs):
        at = (F.col("total") - 1) * F.lit(float(p))
        low, high = F.floor(at), F.ceil(at)
        aggs += [F.max(F.when(here(low), F.col("value"))).alias(f"lo{i}"), F.max(F.when(here(high), F.col("value"))).alias(f"hi{i}"),
                 F.max(at - low).alias(f"part{i}")]
        lo, hi, part = F.col(f"lo{i}"), F.col(f"hi{i}"), F.col(f"part{i}")
        values.append(F.when(lo == hi, lo).otherwise((F.lit(1.0) - part) * lo + part * hi))
    return ranked.groupBy(F.col("g").alias(group)).agg(*aggs).select(group, F.array(*values).alias("p"))
