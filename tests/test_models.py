"""Model tests: solvers against closed forms / optimality, folds, scaling,
persistence, ensemble averaging, transform(fit(x)) properties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabflow.models import ensemble as E
from tabflow.models import folds, linear
from tabflow.models import search as S
from tabflow.plans.features import FeaturePipeline, FeaturePipelineModel
from tabflow.roles import FIXTURE_ROLES as R
from tabflow.sources.tables import sales

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def xy(spark):
    rng = np.random.default_rng(7)
    n = 400
    X = rng.normal(size=(n, 3)) * [1.0, 5.0, 0.1] + [10.0, 2000.0, 0.0]
    y = X @ [2.0, -0.3, 40.0] + rng.normal(size=n)
    rows = [(i, i % 4, *map(float, X[i]), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, fold int, a double, b double, c double, y double")
    return df, X, y


def _scaled(X):
    m, s = X.mean(0), X.std(0)
    return (X - m) / s, m, s


def test_ridge_matches_closed_form(xy):
    df, X, y = xy
    Xs, m, s = _scaled(X)
    alpha = 10.0
    yc = y - y.mean()
    w = np.linalg.solve(Xs.T @ Xs + alpha * np.eye(3), Xs.T @ yc)
    model = linear.fit_linear(df, ["a", "b", "c"], "y", linear.LinearConfig("r", "ridge", alpha))
    assert np.allclose(model.getOrDefault("coefficients"), w / s, rtol=1e-8)


def test_lasso_optimality(xy):
    df, X, y = xy
    Xs, m, s = _scaled(X)
    n = len(y)
    alpha = 0.5
    model = linear.fit_linear(df, ["a", "b", "c"], "y", linear.LinearConfig("l", "lasso", alpha))
    ws = np.array(model.getOrDefault("coefficients")) * s
    g = Xs.T @ (y - y.mean() - Xs @ ws) / n
    for j in range(3):
        if ws[j] != 0:
            assert abs(g[j] - alpha * np.sign(ws[j])) < 1e-6
        else:
            assert abs(g[j]) <= alpha + 1e-6


def test_cv_linear_matches_per_fold_fit(xy, spark):
    df, X, y = xy
    cfg = linear.LinearConfig("ols", "ols")
    fm, sol = linear.cv_linear(df, ["a", "b", "c"], "y", "fold", [cfg])
    b, w = sol[("ols", 2)]
    tr = np.array([r % 4 != 2 for r in range(len(y))])
    A = np.c_[np.ones(tr.sum()), X[tr]]
    ref = np.linalg.lstsq(A, y[tr], rcond=None)[0]
    assert np.allclose([b, *w], ref, rtol=1e-7)
    pred = ref[0] + X[~tr] @ ref[1:]
    rmse = float(np.sqrt(np.mean((y[~tr] - pred) ** 2)))
    got = fm.where("fold = 2").first()["rmse"]
    assert abs(got - rmse) < 1e-8


def test_population_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    out = linear.fit_population_scaler(df, ["x", "k"]).transform(df).collect()
    assert [r["x"] for r in out] == [-1.0, 1.0]          # population std = 1
    assert [r["k"] for r in out] == [0.0, 0.0]           # constant -> divisor 1


def test_hash_folds_partition_rows_and_are_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = {r["k"]: r["fold"] for r in folds.with_folds(df.repartition(1), 5, ["k"]).collect()}
    b = {r["k"]: r["fold"] for r in folds.with_folds(df.repartition(7), 5, ["k"]).collect()}
    assert a == b and set(a.values()) == set(range(5))


def test_feature_pipeline_fit_transform_property_and_persistence(spark, tmp_path):
    s = sales(spark, SF)
    train = s.where("split = 'train'")
    m = FeaturePipeline(R).fit(train)
    a = sorted(m.transform(train).collect())
    b = sorted(FeaturePipeline(R).fit(train).transform(train).collect())
    assert a == b
    m.write().overwrite().save(str(tmp_path / "fp"))
    m2 = FeaturePipelineModel.load(str(tmp_path / "fp"))
    assert sorted(m2.transform(train).collect()) == a


def test_feature_pipeline_partition_invariant(spark):
    """Same result with 1 and 13 partitions (up to floating summation order)."""
    from tabflow.plans.oracle import round_doubles
    s = sales(spark, SF).where("split = 'train'")
    a = sorted(round_doubles(FeaturePipeline(R).fit(s.repartition(1)).transform(s), 8).collect())
    b = sorted(round_doubles(FeaturePipeline(R).fit(s.repartition(13)).transform(s), 8).collect())
    assert a == b


def test_per_batch_statistics_option(spark):
    s = sales(spark, SF)
    m = FeaturePipeline(R, frozen=False, unknown="missing").fit(s.where("split = 'train'"))
    assert m.transform(s.where("split = 'test'")).count() == s.where("split = 'test'").count()


def test_ensemble_is_mean_of_members_and_roundtrips(xy, tmp_path):
    df, X, y = xy
    members = [S.Candidate("ols", "linear_ols", {"kind": "ols"}),
               S.Candidate("tree", "decision_tree", {"maxDepth": 3})]
    ens = E.fit_ensemble(df, members, ["a", "b", "c"], "y")
    out = ens.transform(df).collect()
    for r in out[:20]:
        assert abs(r["prediction"] - (r["pred_ols"] + r["pred_tree"]) / 2) < 1e-9
    ens.write().overwrite().save(str(tmp_path / "ens"))
    back = E.AveragingEnsembleModel.load(str(tmp_path / "ens")).transform(df).collect()
    assert [r["prediction"] for r in back] == [r["prediction"] for r in out]


def test_models_beat_mean_baseline(spark):
    from tabflow.plans import catalog
    df = catalog._engineered(spark, SF)
    cands = [S.Candidate("mean", "linear_mean", {"kind": "mean"}), S.Candidate("ols", "linear_ols", {"kind": "ols"}),
             S.Candidate("tree", "decision_tree", {"maxDepth": 6})]
    trials, _ = S.search(df, cands, catalog.E3_FEATURES, "sales")
    r = {x["model"]: x["rmse_mean"] for x in trials.collect()}
    assert r["ols"] < r["mean"] and r["tree"] < r["mean"]


def test_random_draws_seeded():
    space = {"a": ("int", 1, 9), "b": ("logfloat", 0.01, 1.0), "c": ("choice", ["x", "y"])}
    assert S.draw(space, 5, 3) == S.draw(space, 5, 3)
    assert len(S.grid({"p": [1, 2], "q": [3, 4, 5]})) == 6


def test_streaming_scoring_matches_batch(spark, tmp_path):
    from pyspark.ml import PipelineModel

    from tabflow.models.scoring import SelectColumns, load_and_score
    from tabflow.streaming.scoring import score_stream
    s = sales(spark, SF)
    train, test = s.where("split = 'train'"), s.where("split = 'test'").drop("sales")
    fm = FeaturePipeline(R, unknown="missing").fit(train)
    feats = ["weight", "visibility", "price", "outlet_age", "outlet_type"]
    lin = E.fit_candidate(fm.transform(train), S.Candidate("ols", "linear_ols", {"kind": "ols"}), feats, "sales",
                          "prediction")
    PipelineModel([fm, SelectColumns(["item_id"] + feats), lin]).write().overwrite().save(str(tmp_path / "m"))
    test.write.parquet(str(tmp_path / "in"))
    qy = score_stream(spark, str(tmp_path / "m"), str(tmp_path / "in"), test.schema, str(tmp_path / "out"),
                      "item_id", "sales", checkpoint=str(tmp_path / "ck"), sink_fmt="parquet")
    qy.awaitTermination(120)
    streamed = sorted(spark.read.parquet(str(tmp_path / "out")).collect())
    batch = sorted(load_and_score(str(tmp_path / "m"), test, "item_id", "sales").collect())
    assert streamed == batch and len(batch) > 0


def test_ensemble_cv_reuses_search_fold_models(xy):
    df, X, y = xy
    members = [S.Candidate("ols", "linear_ols", {"kind": "ols"}),
               S.Candidate("tree", "decision_tree", {"maxDepth": 3})]
    kept = {}
    S.cross_validate(df, members, ["a", "b", "c"], "y", "fold", keep_models=kept)
    assert len(kept) == 2 * 4
    refit = sorted(E.cv_ensemble(df, members, ["a", "b", "c"], "y", "fold").collect())
    reused = sorted(E.cv_ensemble(df, members, ["a", "b", "c"], "y", "fold", fold_models=kept).collect())
    for a, b in zip(refit, reused):
        assert a["fold"] == b["fold"] and a["n"] == b["n"]
        assert abs(a["rmse"] - b["rmse"]) < 1e-6 * max(1.0, a["rmse"])


def test_global_fit_scope_changes_only_penalized_models(xy):
    df, X, y = xy
    cands = [S.Candidate("ols", "linear_ols", {"kind": "ols"}),
             S.Candidate("ridge", "linear_ridge", {"kind": "ridge", "alpha": 200.0})]
    a = {(r["model"], r["fold"]): r["rmse"] for r in S.cross_validate(df, cands, ["a", "b", "c"], "y").collect()}
    b = {(r["model"], r["fold"]): r["rmse"] for r in
         S.cross_validate(df, cands, ["a", "b", "c"], "y", fit_scope="global").collect()}
    assert all(abs(a[k] - b[k]) < 1e-8 for k in a if k[0] == "ols")      # scaling cannot change OLS
    assert any(abs(a[k] - b[k]) > 1e-9 for k in a if k[0] == "ridge")
