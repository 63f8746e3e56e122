"""Cross-validated evaluation and hyperparameter search.

Linear configurations are scored all at once from per-fold moments
(:func:`tabflow.models.linear.cv_linear`).  Tree configurations train one
Spark ML pipeline per (configuration, fold); the driver submits those fits
from a thread pool so several Spark jobs share the cluster, and the
held-out predictions of all folds of a configuration are scored in one
aggregate.  The narrow modelling table (features, target, fold) is
persisted (memory and disk) for the duration of a search and released
after, so the feature pipeline is evaluated once rather than inside every
wide aggregate and every fit; a lost executor recomputes its partitions
from the lineage (scan + projections).
"""

from __future__ import annotations

import contextlib
import json
import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from itertools import product

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions.columns import mean_pm_std, q
from tabflow.models import binned, blocks, boosting, forest, linear
from tabflow.models.estimators import BOOST_FAMILIES, EXACT_FAMILIES, LASSO_ALPHAS, RIDGE_ALPHAS, TREE_FAMILIES, tree_pipeline
from tabflow.models.metrics import regression_metrics, summarize_folds
from tabflow.models.study import Study

SEED = 42


@dataclass(frozen=True)
class Candidate:
    """One configuration of one family, e.g. ``("rf_3", "random_forest", {...})``."""
    name: str
    family: str
    params: dict = field(default_factory=dict, hash=False, compare=False)

    def params_json(self) -> str:
        return json.dumps(self.params, sort_keys=True)


def grid(space: dict) -> list[dict]:
    """Every combination of a ``{param: [values]}`` grid."""
    keys = sorted(space)
    return [dict(zip(keys, vals)) for vals in product(*[space[k] for k in keys])]


def draw(space: dict, n: int, seed: int = SEED) -> list[dict]:
    """``n`` seeded random draws; value kinds ``int``, ``float``,
    ``logfloat`` (uniform in log space) and ``choice``."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        p = {}
        for k in sorted(space):
            spec = space[k]
            kind = spec[0]
            if kind == "int":
                p[k] = rnd.randint(spec[1], spec[2])
            elif kind == "float":
                p[k] = rnd.uniform(spec[1], spec[2])
            elif kind == "logfloat":
                p[k] = math.exp(rnd.uniform(math.log(spec[1]), math.log(spec[2])))
            elif kind == "choice":
                p[k] = spec[1][rnd.randrange(len(spec[1]))]
            else:
                raise ValueError(f"unknown space kind {kind!r}")
        out.append(p)
    return out


def linear_candidates(ridge=RIDGE_ALPHAS, lasso=LASSO_ALPHAS, enet=(), l1_ratio: float = 0.5,
                      ols: bool = True, mean: bool = False) -> list[Candidate]:
    """M8-M11 grids (scaled, as the reference evaluates linear models)."""
    c = []
    if mean:
        c.append(Candidate("mean", "linear_mean", {"kind": "mean"}))
    if ols:
        c.append(Candidate("ols", "linear_ols", {"kind": "ols"}))
    c += [Candidate(f"ridge_{a:g}", "linear_ridge", {"kind": "ridge", "alpha": a}) for a in ridge]
    c += [Candidate(f"lasso_{a:g}", "linear_lasso", {"kind": "lasso", "alpha": a}) for a in lasso]
    c += [Candidate(f"enet_{a:g}", "linear_enet", {"kind": "enet", "alpha": a, "l1_ratio": l1_ratio})
          for a in enet]
    return c


def _linear_config(c: Candidate) -> linear.LinearConfig:
    p = c.params
    return linear.LinearConfig(c.name, p.get("kind", "ols"), float(p.get("alpha", 0.0)),
                               float(p.get("l1_ratio", 1.0)), bool(p.get("scale", True)))


ASSEMBLED = "__features"


def _cv_tree(data: DataFrame, c: Candidate, features, target: str, fold_col: str, folds,
             pool: ThreadPoolExecutor, keep: dict | None = None) -> DataFrame:
    """``data`` carries the assembled vector, so a fit only trains; a kept model
    assembles for itself."""
    assembler, regressor = tree_pipeline(c.family, c.params, features, target, name=c.name, prediction_col="__p").getStages()
    own = regressor.copy({regressor.featuresCol: ASSEMBLED})

    def fit(f):
        return own.fit(data.where(q(fold_col) != F.lit(f)))

    models = list(pool.map(fit, folds))
    preds = [m.transform(data.where(q(fold_col) == F.lit(f))).select(
        F.lit(c.name).alias("model"), q(fold_col).cast("int").alias("fold"), q(target).alias("__y"), "__p")
        for f, m in zip(folds, models)]
    if keep is not None:
        for f, m in zip(folds, models):
            keep[(c.name, f)] = PipelineModel([assembler, m.copy({m.featuresCol: assembler.getOutputCol()})])
    return regression_metrics(reduce(DataFrame.unionByName, preds), "__y", "__p", by=("model", "fold"))


def cross_validate(df: DataFrame, candidates, features, target: str, fold_col: str = "fold",
                   parallelism: int = 4, keep_models: dict | None = None, fit_scope: str = "fold",
                   on_null: str = "error", packs: blocks.Packs | None = None) -> DataFrame:
    """Fold metrics ``(model, fold, n, rmse, mae, r2)`` for every
    candidate (collected: candidates x folds rows).  ``keep_models`` (a
    dict) receives every fold model as ``(name, fold) -> model`` so an
    ensemble can be scored without refitting its members.  ``fit_scope``
    for linear scaling: ``"fold"`` (default) or ``"global"`` (T10).  A null
    feature or target fails with the number of such rows unless
    ``on_null="drop"`` leaves them out (``n`` then counts the rows used).
    ``packs`` (:func:`prepared`) holds the table and its blocks for several calls."""
    features = list(features)
    spark = df.sparkSession
    lin = [c for c in candidates if c.family.startswith("linear_")]
    specs = {c.name: binned.spec_of(c.family, c.params, len(features)) for c in candidates if c.family in TREE_FAMILIES}
    shared = [c for c in candidates if specs.get(c.name)]
    # parameters that only Spark's own learner knows
    trees = [c for c in candidates if c.family in TREE_FAMILIES and not specs[c.name]]
    boosted = [c for c in candidates if c.family in BOOST_FAMILIES]
    exact = [c for c in candidates if c.family in EXACT_FAMILIES]
    # the narrow modelling table (features, target, fold) is materialized once:
    # the linear passes and every tree fit read it instead of re-evaluating the
    # feature pipeline's expressions inside wide aggregates
    with contextlib.nullcontext(packs) if packs is not None else prepared(df, features, target, [fold_col], on_null, packed_once(candidates, features)) as packs:
        data = packs.df
        if trees and on_null == "error":
            linear.check_complete(data, features, target)
        # Spark's own fits need the folds
        folds = sorted(r[0] for r in data.select(q(fold_col)).distinct().collect()) if trees else []
        out = []
        if shared:
            out += binned.cross_validate(data, [(c.name, *specs[c.name]) for c in shared], features, target, fold_col, on_null, keep_models, packs)
        if boosted:
            out += _cv_boosted(packs.get(fold_col), boosted, keep_models)
        if exact:
            out += forest.cross_validate(data, [(c.name, forest.forest_params(c.family, c.params)) for c in exact], features, target, fold_col,
                                         on_null, keep_models, packs)
        if lin:
            m, sol = linear.cv_linear(data, features, target, fold_col, [_linear_config(c) for c in lin],
                                      fit_scope)
            out += m.collect()
            if keep_models is not None:
                for (name, f), (b, w) in sol.items():
                    if f is not None:
                        keep_models[(name, f)] = linear.LinearFormulaModel(features, list(w), b, "__p")
        if trees:
            vectors = VectorAssembler(inputCols=features, outputCol=ASSEMBLED, handleInvalid="error").transform(data).select(
                q(target), q(fold_col), ASSEMBLED).persist(StorageLevel.MEMORY_AND_DISK)
            with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
                # configurations in parallel too: each submits its fold fits to the same pool
                with ThreadPoolExecutor(max_workers=max(1, parallelism)) as outer:
                    parts = list(outer.map(
                        lambda c: _cv_tree(vectors, c, features, target, fold_col, folds, pool,
                                           keep_models).collect(), trees))
            vectors.unpersist()
            for p in parts:
                out += p
        schema = "model string, fold int, n bigint, rmse double, mae double, r2 double"
        return spark.createDataFrame([tuple(r) for r in out], schema)


def packed_once(candidates, features) -> bool:
    """Whether all candidates read one kind of blocks, and none the rows themselves."""
    kinds = set()
    for c in candidates:
        spec = binned.spec_of(c.family, c.params, len(list(features))) if c.family in TREE_FAMILIES else None
        kinds.add(spec[1] if spec else c.family in EXACT_FAMILIES if c.family in (*BOOST_FAMILIES, *EXACT_FAMILIES) else "rows")
    return len(kinds) == 1 and "rows" not in kinds


@contextlib.contextmanager
def prepared(df: DataFrame, features, target: str, fold_cols, on_null: str = "error", once: bool = False):
    """The narrow modelling table, computed once and packed once for all cross-validations inside the block; with ``once``
    (:func:`packed_once`) it is released as soon as it is packed."""
    features, fold_cols = list(features), list(dict.fromkeys(fold_cols))
    data = linear.complete_rows(df.select(*[q(c) for c in dict.fromkeys([*features, target, *fold_cols])]),
                                features, target, on_null).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with blocks.Packs(data, features, target, fold_cols, on_null, once) as packs:
            yield packs
    finally:
        data.unpersist()


def _cv_boosted(packed: blocks.Blocks, candidates, keep: dict | None) -> list[tuple]:
    """Fold metrics of boosted candidates: all settings and folds grow in the same passes over the packed table."""
    jobs = [(c, f) for c in candidates for f in sorted(packed.folds)]
    fitted = boosting.train(packed, [(boosting.boost_params(c.family.removeprefix("boosted_"), c.params), f) for c, f in jobs], keep_trees=keep is not None)
    if keep is not None:
        for (c, f), m in zip(jobs, fitted):
            keep[(c.name, f)] = PipelineModel([boosting.model_of(packed, m, "__p")])
    return [(c.name, f, *m.metrics) for (c, f), m in zip(jobs, fitted)]


def study(df: DataFrame, family: str, space: dict, features, target: str, fold_col: str, path: str, n_trials: int, at_once: int = 1,
          seed: int = SEED, packs: blocks.Packs | None = None) -> Study:
    """A sequential study of one family; a trial's value is its mean RMSE over the folds, the trials of a batch are
    cross-validated together over blocks packed once, and the table at ``path`` lets the study resume."""
    def objective(batch):
        named = [Candidate(f"trial_{n}", family, p) for n, p in batch]
        fm = cross_validate(df, named, features, target, fold_col, packs=packs)
        means = {r["model"]: r["value"] for r in fm.groupBy("model").agg(F.avg("rmse").alias("value")).collect()}
        return [means.get(c.name) for c in named]

    found = Study(df.sparkSession, space, path, seed)
    with contextlib.nullcontext(packs) if packs is not None else prepared(df, features, target, [fold_col]) as packs:
        found.run(objective, n_trials, at_once)
    return found


def search(df: DataFrame, candidates, features, target: str, fold_col: str = "fold",
           parallelism: int = 4, keep_models: dict | None = None, packs: blocks.Packs | None = None) -> tuple[DataFrame, DataFrame]:
    """``(trials, fold_metrics)``; ``trials`` = one row per
    candidate with family, params JSON, whether its inputs are scaled, the fold
    summary with its texts and the mean MSE by which a search ranks."""
    candidates = list(candidates)
    fm = cross_validate(df, candidates, features, target, fold_col, parallelism, keep_models, packs=packs)
    spark = df.sparkSession
    meta = spark.createDataFrame([(c.name, c.family, c.params_json(), uses_scaling(c)) for c in candidates],
                                 "model string, family string, params string, use_scaling boolean")
    return meta.join(trial_summary(fm), "model", "left"), fm


def uses_scaling(c: Candidate) -> bool:
    """Whether a candidate's inputs are scaled in its fits: linear models but the mean, unless told otherwise."""
    return c.family.startswith("linear_") and c.family != "linear_mean" and bool(c.params.get("scale", True))


def trial_summary(fm: DataFrame) -> DataFrame:
    """M5 per model with the ``mean ± std`` text of R^2 and the mean MSE over folds."""
    mse = fm.groupBy("model").agg(F.avg(F.col("rmse") * F.col("rmse")).alias("mse_mean"))
    return (summarize_folds(fm, by=("model",)).withColumn("r2_text", mean_pm_std("r2_mean", "r2_std", 4))
            .join(mse, "model"))


def best_by_family(trials: DataFrame) -> list:
    """Best candidate per family (lowest mean MSE over folds, name tiebreak); a
    tiny driver-side list of (family, name, params)."""
    rows = trials.where(F.col("mse_mean").isNotNull()).select("family", "model", "params", "rmse_mean", "mse_mean").collect()
    best = {}
    for r in sorted(rows, key=lambda r: (r["mse_mean"], r["model"])):
        best.setdefault(r["family"], r)
    return [best[f] for f in sorted(best)]


def tune_and_evaluate(df: DataFrame, candidates, features, target: str, tune_fold: str, eval_fold: str,
                      parallelism: int = 4, keep_models: dict | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Search on one set of folds, then score each family's winner on another:
    ``(trials, evaluated, fold_metrics)``.  ``evaluated`` has one row per family;
    its scores come from folds that took no part in choosing the parameters."""
    candidates = list(candidates)
    with prepared(df, features, target, [tune_fold, eval_fold], once=packed_once(candidates, features)) as packs:
        trials, _ = search(df, candidates, features, target, tune_fold, parallelism, packs=packs)
        chosen = {r["model"] for r in best_by_family(trials)}
        evaluated, fm = search(df, [c for c in candidates if c.name in chosen], features, target, eval_fold, parallelism, keep_models, packs)
    return trials, evaluated, fm
