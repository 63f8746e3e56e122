"""Spark ML regressors by family, named stages.

Each family is a two-stage ``Pipeline``: ``VectorAssembler`` over the named
feature columns, then the regressor.  Column names carry the model name so
several fitted members can be chained on one DataFrame (J7, M20).

Reference hyperparameters map to Spark as follows (the rest have no
counterpart and are dropped): depth -> maxDepth, number of trees ->
numTrees / maxIter, learning rate -> stepSize, min samples / child weight
per leaf -> minInstancesPerNode, subsample -> subsamplingRate, column
fraction / max_features -> featureSubsetStrategy, gamma -> minInfoGain.
Extra trees become a forest without bootstrap (random split thresholds have
no Spark counterpart).  ``boosted_trees`` is Spark's own GBTRegressor; the roles of the
reference's three boosting libraries are the families ``boosted_depth``, ``boosted_leaf`` and
``boosted_symmetric`` of :mod:`tabflow.models.boosting`, with all their parameters; trees with exact
cuts and ``min_samples_split``, forests of them and trees of random cuts are the families
``exact_tree``, ``exact_forest`` and ``random_cut_trees`` of :mod:`tabflow.models.forest`.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor

from tabflow.models.linear import KINDS as LINEAR_KINDS

SEED = 42
TREE_FAMILIES = ("decision_tree", "random_forest", "extra_trees", "boosted_trees")
BOOST_FAMILIES = ("boosted_depth", "boosted_leaf", "boosted_symmetric")
EXACT_FAMILIES = ("exact_tree", "exact_forest", "random_cut_trees")
FAMILIES = tuple(f"linear_{k}" for k in LINEAR_KINDS) + TREE_FAMILIES + BOOST_FAMILIES + EXACT_FAMILIES

# The reference's search spaces, mapped to Spark names.
# ("int", lo, hi) / ("float", lo, hi) / ("logfloat", lo, hi) / ("choice", [...])
RIDGE_ALPHAS = (0.1, 1.0, 10.0, 50.0, 100.0, 200.0, 500.0)
LASSO_ALPHAS = (0.01, 0.1, 1.0, 10.0, 50.0, 100.0)
TREE_GRID = {"maxDepth": [5, 10, 15, 20], "minInstancesPerNode": [1, 2, 4]}
FOREST_SPACE = {"numTrees": ("choice", [100, 200, 300]), "maxDepth": ("choice", [10, 15, 20]),
                "minInstancesPerNode": ("choice", [1, 2, 4]),
                "featureSubsetStrategy": ("choice", ["sqrt", "log2"])}
# The reference tunes three vendor boosters; this is the space of the one with Spark's parameters: the same rounds and the same kinds
# of parameters.  Trials: the reference's setting (its defaults differ, 50 to 200).
BOOST_TRIALS = 100
BOOSTED_SPACE = {"maxIter": ("int", 500, 2000), "stepSize": ("logfloat", 0.01, 0.3),
                 "maxDepth": ("int", 3, 12), "subsamplingRate": ("float", 0.6, 1.0),
                 "featureSubsetStrategy": ("choice", ["0.6", "0.8", "1.0"]),
                 "minInstancesPerNode": ("int", 1, 100), "minInfoGain": ("float", 0.0, 0.1)}
# The reference's whole grid of decision trees and its space of forests and extra trees, by its own names.
EXACT_TREE_GRID = {"max_depth": [5, 10, 15, 20], "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4]}
EXACT_FOREST_SPACE = {"n_estimators": ("choice", [100, 200, 300]), "max_depth": ("choice", [10, 15, 20]),
                      "min_samples_split": ("choice", [2, 5, 10]), "min_samples_leaf": ("choice", [1, 2, 4]),
                      "max_features": ("choice", ["sqrt", "log2"])}
# The reference's spaces of its three boosters, by the vendors' names.
BOOST_SPACES = {
    "boosted_leaf": {
        "n_estimators": ("int", 500, 2000), "learning_rate": ("logfloat", 0.01, 0.3), "max_depth": ("int", 3, 12),
        "num_leaves": ("int", 20, 300), "subsample": ("float", 0.6, 1.0), "colsample_bytree": ("float", 0.6, 1.0),
        "reg_alpha": ("float", 0.0, 10.0), "reg_lambda": ("float", 0.0, 10.0), "min_child_samples": ("int", 5, 100)},
    "boosted_depth": {
        "n_estimators": ("int", 500, 2000), "learning_rate": ("logfloat", 0.01, 0.3), "max_depth": ("int", 3, 12),
        "subsample": ("float", 0.6, 1.0), "colsample_bytree": ("float", 0.6, 1.0), "reg_alpha": ("float", 0.0, 10.0),
        "reg_lambda": ("float", 0.0, 10.0), "min_child_weight": ("int", 1, 10), "gamma": ("float", 0.0, 10.0)},
    "boosted_symmetric": {
        "iterations": ("int", 500, 2000), "learning_rate": ("logfloat", 0.01, 0.3), "depth": ("int", 3, 10),
        "l2_leaf_reg": ("float", 1.0, 10.0), "subsample": ("float", 0.6, 1.0), "colsample_bylevel": ("float", 0.6, 1.0),
        "min_data_in_leaf": ("int", 1, 50)},
}


def _regressor(family: str, params: dict, features_col: str, label: str, prediction_col: str):
    p = dict(params)
    common = dict(featuresCol=features_col, labelCol=label, predictionCol=prediction_col)
    if family == "decision_tree":
        return DecisionTreeRegressor(seed=SEED, **common, **p)
    if family == "random_forest":
        return RandomForestRegressor(seed=SEED, bootstrap=True, **common, **p)
    if family == "extra_trees":
        return RandomForestRegressor(seed=SEED, bootstrap=False, **common, **p)
    if family == "boosted_trees":
        return GBTRegressor(seed=SEED, **common, **p)
    raise ValueError(f"unknown tree family {family!r}")


def tree_pipeline(family: str, params: dict, features, label: str, name: str = "model",
                  prediction_col: str | None = None) -> Pipeline:
    """VectorAssembler + regressor; ``handleInvalid="error"`` so a null
    feature fails loudly instead of silently dropping rows."""
    fcol = f"__features_{name}"
    va = VectorAssembler(inputCols=list(features), outputCol=fcol, handleInvalid="error")
    return Pipeline(stages=[va, _regressor(family, params, fcol, label, prediction_col or "prediction")])


def model_params(model) -> list[tuple[str, str, str]]:
    """``(stage, param, value)`` of every stage with an explicit or
    default value."""
    stages = getattr(model, "stages", [model])
    rows = []
    for s in stages:
        for p, v in s.extractParamMap().items():
            rows.append((type(s).__name__, p.name, str(v)))
    return rows
