"""Trees grown in shared passes: against brute force over the same bins, with and without subtrees grown in tasks."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabflow.models import binned as N
from tabflow.models import blocks as B
from tabflow.models import boosting as G
from tabflow.models import ensemble as E
from tabflow.models import forest as T
from tabflow.models import search as S
from tabflow.models import subtrees

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    n = 1200
    x = np.stack([rng.normal(size=n), rng.normal(size=n).round(1), rng.integers(0, 5, n).astype(float)])
    y = 3.0 * (x[0] > 0.2) + x[1] * (x[2] > 2) + rng.normal(size=n) / 4
    rows = [(*map(float, x[:, i]), float(y[i]), i % 3) for i in range(n)]
    return spark.createDataFrame(rows, "a double, b double, c double, y double, fold int").repartition(3), x, y, np.arange(n) % 3


def brute(bins, y, rows, spec, level=0):
    best = None
    if level < spec.depth:
        for f in range(len(bins)):
            for cut in range(bins[f].max()):
                left = bins[f, rows] <= cut
                k = left.sum()
                if min(k, len(rows) - k) >= spec.min_rows:
                    g = y[rows].var() * len(rows) - y[rows][left].var() * k - y[rows][~left].var() * (len(rows) - k)
                    if g > 1e-9 and g / len(rows) >= spec.min_gain and (best is None or g > best[0] + 1e-7):
                        best = (g, f, cut)
    if not best:
        return lambda b: y[rows].mean()
    _, f, cut = best
    go = bins[f, rows] <= cut
    left, right = brute(bins, y, rows[go], spec, level + 1), brute(bins, y, rows[~go], spec, level + 1)
    return lambda b: left(b) if b[f] <= cut else right(b)


def errors(predict, bins, y, rows):
    e = np.array([predict(bins[:, i]) for i in rows]) - y[rows]
    return len(rows), np.sqrt((e * e).mean()), np.abs(e).mean()


def test_trees_of_all_folds_equal_brute_force(data):
    df, x, y, fold = data
    specs = {"d2": N.Spec(depth=2, seed=0), "d4": N.Spec(depth=4, seed=0), "leaf": N.Spec(depth=4, min_rows=40, seed=0), "gain": N.Spec(depth=4, min_gain=0.05, seed=0)}
    packed = B.pack(df, FEATURES, "y", "fold", bins=32)
    bins = B.binned(x, packed.cuts).astype(int)
    got = {(r[0], r[1]): r[2:5] for r in N.cross_validate(df, [(n, s, 32) for n, s in specs.items()], FEATURES, "y", "fold")}
    for (name, f), found in got.items():
        want = errors(brute(bins, y, np.flatnonzero(fold != f), specs[name]), bins, y, np.flatnonzero(fold == f))
        assert np.allclose(found, want), (name, f)
    assert len(got) == 12


def test_subtrees_in_tasks_change_no_score(data, monkeypatch):
    """A deep tree whose lower nodes leave the passes scores as one grown by passes alone, at every depth."""
    df, *_ = data
    cands = [(f"t{d}_{m}", N.Spec(depth=d, min_rows=m, seed=0), 32) for d in (3, 9, 12) for m in (1, 4)]
    monkeypatch.setattr(N, "LOCAL_LEVELS", 2)
    monkeypatch.setattr(N, "LOCAL_ROWS", 300)
    calls = []
    monkeypatch.setattr(subtrees, "finish", lambda p, e, raw=False, f=subtrees.finish: calls.append(sum(len(g.trees[0].local) for g, *_ in e)) or f(p, e, raw))
    local = N.cross_validate(df, cands, FEATURES, "y", "fold")
    monkeypatch.setattr(N, "LOCAL_ROWS", 0)
    passes = N.cross_validate(df, cands, FEATURES, "y", "fold")
    assert calls[0] > 0 and calls[1] == 0
    for a, b in zip(sorted(local), sorted(passes)):
        assert a[:3] == b[:3] and np.allclose(a[3:], b[3:])


def test_exact_grid_in_tasks_equals_passes(data, monkeypatch):
    df, *_ = data
    cands = [(f"t{d}_{s}_{m}", T.ForestParams(max_depth=d, min_samples_split=s, min_samples_leaf=m)) for d in (2, 6, None) for s in (2, 30) for m in (1, 5)]
    each = []
    for c in cands[::3]:      # every setting by itself, by passes
        each += T.cross_validate(df, [c], FEATURES, "y", "fold", keep={})
    monkeypatch.setattr(T, "LOCAL_LEVELS", 2)
    monkeypatch.setattr(T, "LOCAL_ROWS", 400)
    together = {r[:2]: r[2:] for r in T.cross_validate(df, cands, FEATURES, "y", "fold")}
    assert len(together) == 36
    for name, f, *want in each:
        assert np.allclose(together[name, f], want), (name, f)


def test_sums_of_a_task_are_merged_as_they_come(data, monkeypatch):
    df, *_ = data
    packed = B.pack(df, FEATURES, "y", "fold", raw=True)
    p = replace(T.forest_params("exact_forest", {"n_estimators": 2, "max_depth": 4, "max_features": "sqrt"}))
    whole = T.grow(packed, [(p, 0)])[0]
    monkeypatch.setattr(T, "PENDING_ROWS", 10)
    merged = T.grow(packed, [(p, 0)])[0]
    assert [t.feature for t in merged] == [t.feature for t in whole] and [t.rows for t in merged] == [t.rows for t in whole]


def test_boosting_adds_twice_the_step_and_forests_average(data):
    df, x, y, fold = data
    got = {r["model"]: r["rmse"] for r in S.cross_validate(df, [
        S.Candidate("g", "boosted_trees", {"maxIter": 2, "stepSize": 0.2, "maxDepth": 2}), S.Candidate("f", "random_forest", {"numTrees": 8, "maxDepth": 5}),
        S.Candidate("e", "extra_trees", {"numTrees": 2, "maxDepth": 4, "featureSubsetStrategy": "all"}),
        S.Candidate("t", "decision_tree", {"maxDepth": 4})], FEATURES, "y").where("fold = 1").collect()}
    packed = B.pack(df, FEATURES, "y", "fold", bins=32)
    bins, train, held, spec = B.binned(x, packed.cuts).astype(int), np.flatnonzero(fold != 1), np.flatnonzero(fold == 1), N.Spec(depth=2)
    first = brute(bins, y, train, spec)
    f1 = np.array([first(bins[:, i]) for i in range(len(y))])
    second = brute(bins, y - f1, train, spec)
    f2 = f1 + 0.4 * np.array([second(bins[:, i]) for i in range(len(y))])
    assert np.isclose(got["g"], np.sqrt(((f2 - y)[held] ** 2).mean()))
    assert np.isclose(got["e"], got["t"]) and got["f"] < y[held].std()


def test_refits_and_ensembles_share_the_passes(data):
    df, *_ = data
    cands = [S.Candidate("t", "decision_tree", {"maxDepth": 3}), S.Candidate("f", "random_forest", {"numTrees": 3, "maxDepth": 3}),
             S.Candidate("g", "boosted_trees", {"maxIter": 3, "maxDepth": 2})]
    models = E.fit_trees(df, cands, FEATURES, "y")
    own = E.fit_candidate(df, cands[0], FEATURES, "y")
    a, b = models["t"].transform(df), own.transform(df)
    assert abs(a.agg(F.avg(F.pow(F.col("pred_t") - F.col("y"), 2))).first()[0] - b.agg(F.avg(F.pow(F.col("pred_t") - F.col("y"), 2))).first()[0]) < 0.02
    imp = E.importances(models, FEATURES).collect()
    assert len(imp) == 3 and all(abs(sum(r[m] for r in imp) - 1) < 1e-9 for m in "tfg")
    fm = E.cv_ensemble(df, cands[:2], FEATURES, "y").collect()
    assert len(fm) == 3 and sum(r["n"] for r in fm) == df.count()


def test_a_forest_in_parts_scores_as_one_grown_whole(data, monkeypatch):
    """The driver holds a few trees of a large forest at a time, the scores are the whole forest's at every depth."""
    df, *_ = data
    forest = {"trees": 5, "columns": 2, "bootstrap": True}
    cands = [("single", N.Spec(depth=6, seed=0), 32), ("f3", N.Spec(depth=3, **forest), 32), ("f6", N.Spec(depth=6, **forest), 32),
             ("no_sample", N.Spec(depth=4, trees=3, columns=1), 32)]
    whole = N.cross_validate(df, cands, FEATURES, "y", "fold")
    grown, grow = [], N.grow
    monkeypatch.setattr(N, "grow", lambda p, jobs, **k: grown.append(sum(s.trees for s, _ in jobs)) or grow(p, jobs, **k))
    monkeypatch.setattr(N, "NODES_AT_ONCE", 800)      # two trees of depth 6 on three folds
    parts = N.cross_validate(df, cands, FEATURES, "y", "fold")
    assert len(grown) > 4 and max(grown) < 5 * 3 and sum(grown) == (1 + 5 + 3) * 3
    assert [r[:3] for r in parts] == [r[:3] for r in whole] and len(whole) == 12
    assert np.allclose([r[3:] for r in parts], [r[3:] for r in whole])


def test_many_boosters_train_in_groups_and_their_written_trees_are_forgotten(data, monkeypatch):
    df, *_ = data
    cands = [(f"b{k}", N.Spec(boosted=True, trees=5 + k, depth=2, step=0.3, share=0.8), 32) for k in range(3)]
    whole = N.cross_validate(df, cands, FEATURES, "y", "fold")
    kept, grow = [], N.grow

    def grown(p, jobs, **k):
        out = grow(p, jobs, **k)
        kept.append((len(jobs), max(sum(t is not None for t in g.trees) for g in out[0]), [len(g.trees) for g in out[0]]))
        return out

    monkeypatch.setattr(N, "grow", grown)
    monkeypatch.setattr(G, "AT_ONCE", 4)
    assert np.allclose([r[1:] for r in N.cross_validate(df, cands, FEATURES, "y", "fold")], [r[1:] for r in whole])
    assert [k[0] for k in kept] == [3, 3, 3] and [k[2] for k in kept] == [[5] * 3, [6] * 3, [7] * 3]
    assert all(k[1] <= N.REFRESH for k in kept)
    # as many at a time, and only new trees, for the second-order boosters
    packed = B.pack(df, FEATURES, "y", "fold")
    jobs = [(G.boost_params("depth", {"n_estimators": 3 + k, "max_depth": 2, "subsample": 0.8}), f) for k in range(2) for f in range(3)]
    found = G.train(packed, jobs, keep_trees=False)
    assert [len(m.trees) for m in found] == [3] * 3 + [4] * 3 and all(sum(t is not None for t in m.trees) <= G.REFRESH for m in found)
    monkeypatch.setattr(G, "AT_ONCE", 32)
    assert np.allclose([m.metrics for m in found], [m.metrics for m in G.train(packed, jobs)])
    B.discard(packed.table)
