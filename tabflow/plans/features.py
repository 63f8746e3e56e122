"""The whole fitted feature pipeline as a Spark ML Estimator/Model.

fit      -> statistics in two column-pruned scans:
            (1) one stacked aggregate over (column, value) gives the value
                counts of every categorical (size mode, code dictionaries)
                and, on the outlet entries, the sums from which the weight
                mean, the positive-visibility mean and every outlet's mean
                of the repaired visibility follow algebraically;
            (2) exact price quartiles (the estimate pass is skipped when the
                row count from (1) is under the exact-map guard).
transform-> one projection chain (literal lookups for counted-small state,
            joins for large state); no shuffle when state is small.

``frozen=True`` (default) applies the fitted statistics to new data;
``frozen=False`` re-derives the zero-repair mean, outlet means and quartiles
from each batch, like the reference's ``transform``.
"""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions.columns import q, safe_ratio
from tabflow.functions.lookup import apply_lookup
from tabflow.operators.binning import bin_index, quantile_edges
from tabflow.operators.clean import mapping_expr
from tabflow.operators.encode import Dictionary, dictionaries_from_values, encode, stacked_value_counts
from tabflow.roles import Roles
from tabflow.session import scratch_path

SMALL_TABLE = 20_000


@dataclass
class FeatureStats:
    weight_mean: float | None = None
    size_mode: str | None = None
    vis_pos_mean: float | None = None
    vis_mean: float | None = None             # mean of the repaired visibility over all rows
    outlet_means: dict | None = None          # small: {outlet: mean}
    outlet_table: DataFrame | None = None     # large: (k, v)
    n_outlets: int = 0
    price_edges: list | None = None
    dictionaries: dict = field(default_factory=dict)


def _roles_from_json(s: str) -> Roles:
    d = json.loads(s)
    d["fat_mapping"] = tuple(tuple(x) for x in d.get("fat_mapping", ()))
    d["id_columns"] = tuple(d.get("id_columns", ()))
    return Roles(**d)


def roles_json(r: Roles) -> str:
    return json.dumps(asdict(r))


def _outlet_aggs(w, v) -> list:
    """Per-outlet sums from which every weight / visibility statistic of the
    fit is derived (row count, weight sum/count, positive, non-zero and
    zero visibility sums/counts)."""
    return [F.count(F.lit(1)).alias("rows"), F.sum(w).alias("sw"), F.count(w).alias("nw"),
            F.sum(F.when(v > 0, v)).alias("sp"), F.count_if(v > 0).alias("np"),
            F.sum(F.when(v != 0, v)).alias("snz"), F.count_if(v == 0).alias("nz"), F.count(v).alias("nv")]


def _numeric(df: DataFrame, c: str):
    return q(c).cast("double") if c in df.columns else F.lit(None).cast("double")


def visibility_stats(df: DataFrame, r: Roles, counts: dict | None = None,
                     grouped: DataFrame | None = None) -> tuple:
    """Outlet-grouped sums -> (weight mean, positive-visibility mean, overall
    repaired mean, outlet means as dict or table, number of outlets).  ``grouped`` (``k`` + the
    :func:`_outlet_aggs` columns) is computed here unless the caller already
    has it from a combined pass.  ``counts`` receives the total row count."""
    has = set(df.columns)
    if grouped is None:
        key = q(r.outlet_id).cast("string") if r.outlet_id in has else F.lit(None).cast("string")
        grouped = df.groupBy(key.alias("k")).agg(*_outlet_aggs(_numeric(df, r.weight), _numeric(df, r.visibility)))
    g = grouped.persist()
    try:
        tot = g.agg(*[F.sum(c).alias(c) for c in g.columns if c != "k"]).first().asDict()
        if counts is not None:
            counts["rows"] = tot["rows"] or 0
        wmean = (tot["sw"] / tot["nw"]) if r.weight in has and tot["nw"] else None
        if r.visibility not in has:
            return wmean, None, None, None, None, 0
        pmean = (tot["sp"] / tot["np"]) if tot["np"] else None
        nz, nv = F.col("nz"), F.col("nv")
        snz = F.coalesce(F.col("snz"), F.lit(0.0))
        if pmean is None:
            mean = F.try_divide(snz, nv - nz)
        else:
            mean = F.try_divide(snz + nz * F.lit(pmean), nv)
        seen = (tot["nv"] or 0) - (tot["nz"] or 0) if pmean is None else (tot["nv"] or 0)
        overall = ((tot["snz"] or 0.0) + (0.0 if pmean is None else (tot["nz"] or 0) * pmean)) / seen if seen else None
        means = g.where(F.col("k").isNotNull()).select("k", mean.alias("v"))
        if r.outlet_id not in has:
            return wmean, pmean, overall, None, None, 0
        n = means.count()
        if n <= SMALL_TABLE:
            return wmean, pmean, overall, {x["k"]: x["v"] for x in means.collect()}, None, n
        path = scratch_path(df.sparkSession, "outlet-means")
        means.write.parquet(path)
        return wmean, pmean, overall, None, df.sparkSession.read.schema("k string, v double").parquet(path), n
    finally:
        g.unpersist()


def category_stats(df: DataFrame, r: Roles, encode_cats: bool = True, vc: DataFrame | None = None):
    """Stacked value counts of all categoricals -> (size mode, dictionaries);
    ``vc`` (``column, value, count``) is computed here unless given."""
    cats = [c for c in r.categoricals if c in df.columns]
    if not cats:
        return None, {}
    vc = (vc if vc is not None else stacked_value_counts(df, cats)).persist()
    try:
        mode = None
        if r.size in cats:
            top = (vc.where((F.col("column") == r.size) & F.col("value").isNotNull())
                   .orderBy(F.desc("count"), F.asc("value")).limit(1).collect())
            mode = top[0]["value"] if top else r.size_fallback
        dicts = {}
        if encode_cats:
            col, val = F.col("column"), F.col("value")
            fixed = val
            if r.fat in cats:
                fixed = F.when(col == r.fat, mapping_expr(val, r.fat_mapping)).otherwise(fixed)
            if r.size in cats:
                fixed = F.when((col == r.size) & val.isNull(), F.lit(mode)).otherwise(fixed)
            fixed = F.coalesce(fixed, F.lit(r.missing_token))
            dicts = dictionaries_from_values(vc.select("column", fixed.alias("value")), cats)
        return mode, dicts
    finally:
        vc.unpersist()


OUTLET_ENTRY = "__outlet"


def fit_table(df: DataFrame, r: Roles) -> tuple[DataFrame, str]:
    """One scan for both the categorical value counts and the outlet sums.

    Every row is stacked into one ``(column, value, w, v)`` entry per
    categorical; the outlet entry also carries weight and visibility (the
    others carry nulls), and one grouped aggregate over ``(column, value)``
    yields value counts for every categorical and the outlet sums at once.
    Partial aggregation per task keeps the shuffle at one row per
    (column, value) per task, whatever the skew.  Returns the table and the
    name of the outlet entry."""
    has = set(df.columns)
    cats = [c for c in r.categoricals if c in has]
    entry = r.outlet_id if r.outlet_id in cats else OUTLET_ENTRY
    w, v, none = _numeric(df, r.weight), _numeric(df, r.visibility), F.lit(None).cast("double")

    def item(name, value, carry):
        return F.struct(F.lit(name).alias("column"), value.alias("value"),
                        (w if carry else none).alias("w"), (v if carry else none).alias("v"))

    items = [item(c, q(c).cast("string"), c == entry) for c in cats]
    if entry == OUTLET_ENTRY:
        key = q(r.outlet_id).cast("string") if r.outlet_id in has else F.lit(None).cast("string")
        items.append(item(OUTLET_ENTRY, key, True))
    pairs = df.select(F.explode(F.array(*items)).alias("p")).select("p.*")
    return pairs.groupBy("column", "value").agg(*_outlet_aggs(F.col("w"), F.col("v"))), entry


def fit_stats(df: DataFrame, r: Roles, q_bins: int = 4, encode_cats: bool = True) -> FeatureStats:
    """All fitted statistics in two scans: the combined stacked aggregate
    (:func:`fit_table`) and the exact price quantiles (whose estimate pass is
    skipped when the row count from the first scan is under the guard)."""
    s = FeatureStats()
    counts = {}
    t, entry = fit_table(df, r)
    t = t.persist()
    try:
        grouped = t.where(F.col("column") == entry).select(F.col("value").alias("k"), *[
            c for c in t.columns if c not in ("column", "value")])
        s.weight_mean, s.vis_pos_mean, s.vis_mean, s.outlet_means, s.outlet_table, s.n_outlets = visibility_stats(
            df, r, counts, grouped)
        vc = t.where(F.col("column") != OUTLET_ENTRY).select("column", "value", F.col("rows").alias("count"))
        s.size_mode, s.dictionaries = category_stats(df, r, encode_cats, vc)
    finally:
        t.unpersist()
    if r.price in df.columns:
        s.price_edges = quantile_edges(df, r.price, q_bins, max_rows=counts.get("rows"))
    return s


def _batch_stats(df: DataFrame, r: Roles, s: FeatureStats, q_bins: int) -> FeatureStats:
    """T5 per-batch statistics: zero-repair mean, outlet means, quartiles from
    the batch (after the fitted imputation); the rest stays fitted."""
    b = FeatureStats(**{**s.__dict__})
    base = _impute(df, r, s)
    counts = {}
    _w, b.vis_pos_mean, b.vis_mean, b.outlet_means, b.outlet_table, b.n_outlets = visibility_stats(base, r, counts)
    if r.price in df.columns:
        b.price_edges = quantile_edges(base, r.price, q_bins, max_rows=counts.get("rows"))
    return b


def _impute(df: DataFrame, r: Roles, s: FeatureStats) -> DataFrame:
    has = set(df.columns)
    cols = {}
    if r.weight in has and s.weight_mean is not None:
        cols[r.weight] = F.coalesce(q(r.weight), F.lit(float(s.weight_mean)))
    if r.size in has and s.size_mode is not None:
        cols[r.size] = F.coalesce(q(r.size), F.lit(s.size_mode))
    if r.fat in has:
        cols[r.fat] = mapping_expr(q(r.fat), r.fat_mapping)
    return df.withColumns(cols) if cols else df


def apply_stats(df: DataFrame, r: Roles, s: FeatureStats, encode_cats: bool = True,
                unknown: str = "error") -> DataFrame:
    """The projection chain.  New data always gets values: an outlet that the
    fit has not seen has the overall mean of the repaired visibility, a price
    outside the fitted range falls in the outer bin on its side."""
    has = set(df.columns)
    out = _impute(df, r, s)
    v = q(r.visibility)
    if r.visibility in has:
        fill = F.lit(None).cast("double") if s.vis_pos_mean is None else F.lit(float(s.vis_pos_mean))
        out = out.withColumn(r.visibility, F.when(v == 0, fill).otherwise(v))
    if r.year in has:
        out = out.withColumn(r.outlet_age, F.lit(r.reference_year) - q(r.year))
    if r.visibility in has and r.outlet_id in has:
        mapping = s.outlet_means if s.outlet_means is not None else s.outlet_table
        if mapping is None:
            mapping = {}
        out = apply_lookup(out, r.outlet_id, mapping, r.vis_outlet_mean, n_rows=s.n_outlets)
        fallback = F.lit(None if s.vis_mean is None else float(s.vis_mean)).cast("double")
        out = out.withColumn(r.vis_outlet_mean, F.coalesce(q(r.vis_outlet_mean).cast("double"), fallback))
        out = out.withColumn(r.vis_ratio, safe_ratio(r.visibility, r.vis_outlet_mean))
    if r.price in has and s.price_edges:
        inside = F.when(q(r.price).isNotNull(), F.greatest(F.least(q(r.price), F.lit(s.price_edges[-1])), F.lit(s.price_edges[0])))
        out = out.withColumn(r.price_category, bin_index(inside, s.price_edges, include_lowest=True).cast("int"))
    if r.price in has and r.visibility in has:
        out = out.withColumn(r.price_visibility, q(r.price) * v)
    if r.weight in has and r.visibility in has:
        out = out.withColumn(r.weight_visibility, q(r.weight) * v)
    if r.price in has and r.weight in has:
        out = out.withColumn(r.price_weight_ratio, safe_ratio(r.price, r.weight))
    if encode_cats:
        for c in r.categoricals:
            if c in has and c in s.dictionaries:
                out = encode(out, c, s.dictionaries[c], unknown=unknown,
                             missing_token=r.missing_token)
    return out


class _FeatureParams(Params):
    roles = Param(Params._dummy(), "roles", "role map as JSON", typeConverter=TypeConverters.toString)
    frozen = Param(Params._dummy(), "frozen", "apply fitted batch statistics to new data",
                   typeConverter=TypeConverters.toBoolean)
    qBins = Param(Params._dummy(), "qBins", "number of price quantile bins", typeConverter=TypeConverters.toInt)
    encodeCategoricals = Param(Params._dummy(), "encodeCategoricals", "replace categoricals by codes",
                               typeConverter=TypeConverters.toBoolean)
    unknown = Param(Params._dummy(), "unknown", "unknown category policy: error|keep|missing",
                    typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(roles=roles_json(Roles()), frozen=True, qBins=4, encodeCategoricals=True,
                         unknown="error")

    def getRoles(self) -> Roles:
        return _roles_from_json(self.getOrDefault(self.roles))


class FeaturePipeline(Estimator, _FeatureParams, MLWritable, MLReadable):
    def __init__(self, roles: Roles | None = None, frozen: bool = True, qBins: int = 4,
                 encodeCategoricals: bool = True, unknown: str = "error"):
        super().__init__()
        self._set(roles=roles_json(roles or Roles()), frozen=frozen, qBins=qBins,
                  encodeCategoricals=encodeCategoricals, unknown=unknown)

    def _fit(self, df: DataFrame) -> "FeaturePipelineModel":
        r = self.getRoles()
        stats = fit_stats(df, r, self.getOrDefault(self.qBins), self.getOrDefault(self.encodeCategoricals))
        m = FeaturePipelineModel(stats)
        self._copyValues(m)
        return m

    def write(self):
        return DefaultParamsWriter(self)

    @classmethod
    def read(cls):
        return DefaultParamsReader(cls)


class FeaturePipelineModel(Model, _FeatureParams, MLWritable, MLReadable):
    def __init__(self, stats: FeatureStats | None = None):
        super().__init__()
        self.stats = stats or FeatureStats()

    def _transform(self, df: DataFrame) -> DataFrame:
        r = self.getRoles()
        s = self.stats
        if not self.getOrDefault(self.frozen):
            s = _batch_stats(df, r, s, self.getOrDefault(self.qBins))
        return apply_stats(df, r, s, self.getOrDefault(self.encodeCategoricals),
                           self.getOrDefault(self.unknown))

    def write(self):
        return _ModelWriter(self)

    @classmethod
    def read(cls):
        return _ModelReader(cls)


class _ModelWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        s = self.instance.stats
        state = {"weight_mean": s.weight_mean, "size_mode": s.size_mode,
                 "vis_pos_mean": s.vis_pos_mean, "vis_mean": s.vis_mean,
                 "outlet_table": s.outlet_table is not None, "outlet_means": s.outlet_means,
                 "n_outlets": s.n_outlets, "price_edges": s.price_edges,
                 "dictionaries": {c: {"size": d.size, "values": d.values}
                                  for c, d in s.dictionaries.items()}}
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession,
                                         extraMetadata={"state": state})
        if s.outlet_table is not None:
            s.outlet_table.write.mode("overwrite").parquet(os.path.join(path, "outlet_means"))
        for c, d in s.dictionaries.items():
            if d.table is not None:
                d.table.write.mode("overwrite").parquet(os.path.join(path, "dict", c))


class _ModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        st = meta["state"]
        spark = self.sparkSession
        dicts = {}
        for c, d in st["dictionaries"].items():
            tbl = None if d["values"] is not None else spark.read.parquet(os.path.join(path, "dict", c))
            dicts[c] = Dictionary(size=d["size"], values=d["values"], table=tbl)
        # the metadata says whether a table was written; a missing one fails here
        outlet_table = spark.read.parquet(os.path.join(path, "outlet_means")) if st["outlet_table"] else None
        stats = FeatureStats(weight_mean=st["weight_mean"], size_mode=st["size_mode"],
                             vis_pos_mean=st["vis_pos_mean"], vis_mean=st["vis_mean"], outlet_means=st["outlet_means"],
                             outlet_table=outlet_table, n_outlets=st["n_outlets"],
                             price_edges=st["price_edges"], dictionaries=dicts)
        m = self.cls(stats)
        DefaultParamsReader.getAndSetParams(m, meta)
        return m


def fit_transform(df: DataFrame, roles: Roles | None = None, **kw) -> DataFrame:
    """Convenience: fit on ``df`` and transform it."""
    return FeaturePipeline(roles, **kw).fit(df).transform(df)
