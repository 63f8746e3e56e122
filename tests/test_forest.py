"""Exact trees, forests and extra trees against brute force."""

from dataclasses import replace

import numpy as np
import pytest

from tabflow.models import blocks as B
from tabflow.models import forest as T

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 1500
    x = np.stack([rng.normal(size=n), np.exp(rng.normal(size=n) * 3), rng.integers(0, 7, n).astype(float)])
    y = np.where(x[0] > 0.123, 5.0, 0) + np.log(x[1]) * (x[2] > 3) + rng.normal(size=n)
    rows = [(*map(float, x[:, i]), float(y[i]), i % 3) for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double, fold int").repartition(3)
    return df, x, y, np.arange(n) % 3


def brute(x, y, rows, p, level=0):
    """Nested (gain, feature, threshold, left, right) or a leaf's mean, over every midpoint of every node."""
    g = y[rows]
    best = None
    if (p.max_depth is None or level < p.max_depth) and len(rows) >= max(2, p.min_samples_split):
        for f in range(len(x)):
            order = np.argsort(x[f, rows], kind="stable")
            v, s = x[f, rows][order], np.cumsum(g[order] - g.mean())
            k = np.arange(1, len(rows))
            ok = (v[1:] > v[:-1]) & (k >= p.min_samples_leaf) & (len(rows) - k >= p.min_samples_leaf)
            if ok.any():
                gain = np.where(ok, s[:-1] ** 2 / k + s[:-1] ** 2 / (len(rows) - k), -1)
                i = int(np.argmax(gain))
                if gain[i] > 1e-9 and (best is None or gain[i] > best[0] + 1e-9):
                    best = (gain[i], f, (v[i] + v[i + 1]) / 2)
    if not best:
        return g.mean()
    gain, f, t = best
    return gain, f, t, brute(x, y, rows[x[f, rows] <= t], p, level + 1), brute(x, y, rows[x[f, rows] > t], p, level + 1)


def nested(tree, node=0):
    if tree.feature[node] < 0:
        return tree.value[node]
    return tree.gain[node], tree.feature[node], tree.threshold[node], nested(tree, tree.left[node]), nested(tree, tree.right[node])


def same(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    if not isinstance(a, tuple):
        return np.isclose(a, b)
    return np.isclose(a[0], b[0]) and a[1] == b[1] and np.isclose(a[2], b[2]) and same(a[3], b[3]) and same(a[4], b[4])


def test_exact_trees_equal_brute_force_in_every_fold(data):
    df, x, y, fold = data
    packed = B.pack(df, FEATURES, "y", "fold", raw=True)
    settings = [T.ForestParams(max_depth=4), T.ForestParams(max_depth=9, min_samples_split=40, min_samples_leaf=15)]
    grown = T.grow(packed, [(p, f) for p in settings for f in (0, 2)])
    for (p, f), forest in zip([(p, f) for p in settings for f in (0, 2)], grown):
        assert same(nested(forest[0]), brute(x, y, np.flatnonzero(fold != f), p))
    assert max(len(t[0].feature) for t in grown) > 25


def test_depths_of_one_tree_and_scores(data):
    df, x, y, fold = data
    p = T.ForestParams(min_samples_split=30, min_samples_leaf=10)
    rows = T.cross_validate(df, [("deep", replace(p, max_depth=5)), ("flat", replace(p, max_depth=2))], FEATURES, "y", "fold")
    got = {(n, f): m for n, f, *m in rows}

    def predict(tree, i):
        while isinstance(tree, tuple):
            tree = tree[3] if x[tree[1], i] <= tree[2] else tree[4]
        return tree

    for name, depth in (("deep", 5), ("flat", 2)):
        tree = brute(x, y, np.flatnonzero(fold != 1), replace(p, max_depth=depth))
        e = np.array([predict(tree, i) - y[i] for i in np.flatnonzero(fold == 1)])
        n, rmse, mae, r2 = got[name, 1]
        assert n == len(e) and np.isclose(rmse, np.sqrt((e * e).mean())) and np.isclose(mae, np.abs(e).mean())


def test_random_cuts_lie_in_their_nodes(data):
    df, x, y, fold = data
    packed = B.pack(df, FEATURES, "y", raw=True)
    p = T.ForestParams(3, max_depth=5, min_samples_leaf=5, max_features=2, random_cuts=True)
    forest, = T.grow(packed, [(p, None)])
    thresholds = set()
    for tree in forest:
        members = {0: np.arange(len(y))}
        for node, f in enumerate(tree.feature):
            rows = members[node]
            assert np.isclose(tree.value[node], y[rows].mean()) and tree.rows[node] == len(rows)
            if f < 0:
                continue
            v, t = x[f, rows], tree.threshold[node]
            assert v.min() <= t < v.max()
            left, right = rows[v <= t], rows[v > t]
            assert min(len(left), len(right)) >= 5
            g = y[rows].mean()
            gain = len(left) * (y[left].mean() - g) ** 2 + len(right) * (y[right].mean() - g) ** 2
            assert np.isclose(gain, tree.gain[node])
            members[tree.left[node]], members[tree.right[node]] = left, right
            thresholds.add(t)
    assert len(thresholds) > 20
    again, = T.grow(packed, [(p, None)])
    assert [t.threshold for t in again] == [t.threshold for t in forest]


def test_forest_samples_rows_and_features(data):
    df, x, y, fold = data
    p = T.ForestParams(8, max_depth=6, max_features="sqrt", bootstrap=True)
    model = T.fit(df, FEATURES, "y", p)
    roots = {(t["feature"][0], t["threshold"][0]) for t in model.node_lists()}
    assert len(roots) > 4 and abs(np.mean([t["rows"][0] for t in model.node_lists()]) - len(y)) < 60
    pred = np.array([(r["prediction"], r["y"]) for r in model.transform(df).select("prediction", "y").collect()])
    assert 1 - ((pred[:, 0] - pred[:, 1]) ** 2).mean() / y.var() > 0.5


def test_few_rows_ties_and_constants(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)] * 4 + [(1.0, 3.0, 5.0)] * 2, "one double, x double, y double")
    packed = B.pack(df, ["one", "x"], "y", raw=True)
    for p in (T.ForestParams(), T.ForestParams(random_cuts=True, max_features=1)):
        tree = T.grow(packed, [(p, None)])[0][0]
        assert tree.feature == [1, -1, -1] and sorted(tree.value[1:]) == [3.0, 5.0]
    assert T.grow(packed, [(T.ForestParams(min_samples_split=7), None)])[0][0].feature == [-1]
    assert T.grow(packed, [(T.ForestParams(min_samples_leaf=3), None)])[0][0].feature == [-1]
    with pytest.raises(ValueError, match="max_features"):
        T.ForestParams(max_features="cube").n_features(4)
