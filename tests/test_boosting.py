"""Boosted trees against brute force, the sequential study, folds and importances."""

import heapq
import math
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabflow.models import blocks as B
from tabflow.models import boosting as G
from tabflow.models import study as S
from tabflow.session import scratch_path

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    n = 400
    x = np.stack([rng.integers(0, 12, n), np.round(rng.normal(size=n), 1), rng.integers(0, 3, n) * 1.5])
    y = 3 * x[0] - 5 * (x[1] > 0.3) * x[2] + rng.normal(size=n)
    rows = [(float(x[0, i]), float(x[1, i]), float(x[2, i]), float(y[i]), i % 4) for i in range(n)]
    return spark.createDataFrame(rows, "a double, b double, c double, y double, fold int").repartition(3), x, y


def term(g, h, p):
    return max(abs(g) - p.reg_alpha, 0) ** 2 / (h + p.reg_lambda)


def brute_split(x, g, rows, p):
    """Every feature and value: (gain, feature, value) of the best test, the first on ties."""
    best = None
    total = term(g[rows].sum(), len(rows), p)
    for f in range(len(x)):
        for v in sorted(set(x[f]))[:-1]:
            left = rows[x[f, rows] <= v]
            right = rows[x[f, rows] > v]
            if min(len(left), len(right)) < max(p.min_child, 1):
                continue
            gain = (term(g[left].sum(), len(left), p) + term(g[right].sum(), len(right), p) - total) / 2 - p.gamma
            if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                best = (gain, f, v)
    return best


def brute_leaf(g, rows, p):
    s = g[rows].sum()
    return -math.copysign(max(abs(s) - p.reg_alpha, 0), s) / (len(rows) + p.reg_lambda) * p.learning_rate


def brute_tree(x, g, p):
    """(prediction of every row, gains of the splits in the order they are made)"""
    leaves, gains = [], []
    everything = np.arange(x.shape[1])
    if p.growth == "depth":
        todo = [(everything, 0)]
        while todo:
            rows, level = todo.pop(0)
            found = brute_split(x, g, rows, p) if level < p.max_depth else None
            if not found:
                leaves.append(rows)
                continue
            gain, f, v = found
            gains.append(gain)
            todo += [(rows[x[f, rows] <= v], level + 1), (rows[x[f, rows] > v], level + 1)]
    elif p.growth == "leaf":
        count, heap = 1, []

        def push(rows, level, number):
            found = brute_split(x, g, rows, p) if level < p.max_depth else None
            heapq.heappush(heap, (-found[0] if found else math.inf, number, rows, level, found))

        push(everything, 0, 0)
        number = 1
        while heap[0][4] and count < p.num_leaves:
            _, _, rows, level, (gain, f, v) = heapq.heappop(heap)
            gains.append(gain)
            for part in (rows[x[f, rows] <= v], rows[x[f, rows] > v]):
                push(part, level + 1, number)
                number += 1
            count += 1
        leaves = [h[2] for h in heap]
    else:
        leaves = [everything]
        for _ in range(p.max_depth):
            best = None
            for f in range(len(x)):
                for v in sorted(set(x[f]))[:-1]:
                    total = 0.0
                    for rows in leaves:
                        left, right = rows[x[f, rows] <= v], rows[x[f, rows] > v]
                        if min(len(left), len(right)) >= max(p.min_child, 1):
                            total += (term(g[left].sum(), len(left), p) + term(g[right].sum(), len(right), p) - term(g[rows].sum(), len(rows), p)) / 2 - p.gamma
                    if total > 1e-12 and (best is None or total > best[0] + 1e-9):
                        best = (total, f, v)
            if not best:
                break
            gains.append(best[0])
            leaves = [part for rows in leaves for part in (rows[x[best[1], rows] <= best[2]], rows[x[best[1], rows] > best[2]])]
    out = np.zeros(x.shape[1])
    for rows in leaves:
        if len(rows):
            out[rows] = brute_leaf(g, rows, p)
    return out, gains


SETTINGS = [
    G.BoostParams("depth", rounds=3, learning_rate=0.4, max_depth=4, reg_alpha=2.0, reg_lambda=1.5, gamma=3.0, min_child=7),
    G.BoostParams("leaf", rounds=3, learning_rate=0.3, max_depth=6, num_leaves=9, reg_alpha=0.5, reg_lambda=0.1, min_child=11),
    G.BoostParams("symmetric", rounds=3, learning_rate=0.5, max_depth=4, reg_lambda=3.0, min_child=4),
]


@pytest.mark.parametrize("p", SETTINGS, ids=[p.growth for p in SETTINGS])
@pytest.mark.parametrize("small", [False, True])
def test_trees_equal_brute_force(frame, p, small):
    df, x, y = frame
    packed = B.pack(df, FEATURES, "y")
    p = replace(p, rounds=2) if small else p
    # a small budget of histograms and frequent writes of the predictions change nothing
    fitted = G.train(packed, [(p, None)], refresh=1 if small else 16, histogram_bytes=1 if small else 64 << 20)[0]
    want, total = np.full(len(y), y.mean()), []
    for tree in fitted.trees:
        step, gains = brute_tree(x, want - y, p)
        made = [g * (1 if p.growth != "symmetric" else 1) for g, f in zip(tree.gain, tree.feature) if f >= 0]
        if p.growth == "symmetric":
            depth = len(gains)
            assert len(made) == 2 ** depth - 1
            assert np.allclose([sum(made[2 ** i - 1:2 ** (i + 1) - 1]) for i in range(depth)], gains)
        else:
            assert np.allclose(sorted(made), sorted(gains))
        want = want + step
        total.append(len(made))
    assert min(total) >= 3
    model = G.model_of(packed, fitted)
    got = {(r["a"], r["b"], r["c"]): r["prediction"] for r in model.transform(df).collect()}
    assert np.allclose([got[tuple(map(float, x[:, i]))] for i in range(len(y))], want)


def test_fold_models_train_together_and_score(frame):
    df, x, y = frame
    packed = B.pack(df, FEATURES, "y", "fold")
    p = G.BoostParams("depth", rounds=4, max_depth=3, learning_rate=0.5, subsample=0.7, colsample_bytree=0.7, colsample_bylevel=0.6)
    together = G.train(packed, [(p, f) for f in range(4)] + [(p, None)], refresh=2)
    for fold in (0, 3):
        alone = G.train(packed, [(p, fold)])[0]
        assert [t.feature for t in alone.trees] == [t.feature for t in together[fold].trees]
        pred = G.model_of(packed, alone).transform(df.where(F.col("fold") == fold))
        e = np.array([(r["prediction"], r["y"]) for r in pred.select("prediction", "y").collect()])
        n, rmse, mae, r2 = together[fold].metrics
        d = e[:, 0] - e[:, 1]
        assert n == len(e) and np.isclose(rmse, np.sqrt((d * d).mean())) and np.isclose(mae, np.abs(d).mean())
        assert np.isclose(r2, 1 - (d * d).sum() / ((e[:, 1] - e[:, 1].mean()) ** 2).sum())
    assert together[4].metrics is None


def test_bins_missing_values_and_constant_features(spark):
    df = spark.createDataFrame([(float(i), 1.0, float(i % 2)) for i in range(2000)], "a double, one double, y double")
    packed = B.pack(df, ["a", "one"], "y")
    assert len(packed.cuts[0]) == 255 and len(packed.cuts[1]) == 0
    stump = G.train(packed, [(G.BoostParams(rounds=1, max_depth=1), None)])[0]
    assert len(stump.trees) == 1
    with pytest.raises(ValueError, match="1 rows"):
        B.pack(df.union(spark.createDataFrame([(None, 1.0, 0.0)], df.schema)), ["a", "one"], "y")
    assert B.pack(df.union(spark.createDataFrame([(None, 1.0, 0.0)], df.schema)), ["a"], "y", on_null="drop").folds[0][0] == 2000
    with pytest.raises(ValueError, match="feature"):
        G.train(B.pack(df, [], "y"), [(G.BoostParams(), None)])


def test_saved_model_scores_alike(frame, spark):
    df, _, _ = frame
    for p in SETTINGS[1:]:
        model = G.fit(df, FEATURES, "y", p)
        path = scratch_path(spark, "trees")
        model.write().overwrite().save(path)
        back = G.TreesModel.load(path)
        a, b = (sorted(r[0] for r in m.transform(df).select("prediction").collect()) for m in (model, back))
        assert a == b
    null = spark.createDataFrame([(None, 1.0, 1.5)], "a double, b double, c double")
    assert model.transform(null).first()["prediction"] is None


def test_importance_by_kind(frame, spark):
    df, _, _ = frame
    models = {p.growth: G.fit(df, FEATURES, "y", p) for p in SETTINGS}
    nodes = G.node_table(spark, models)
    rows = G.importance_by_kind(nodes, list(models), [*FEATURES, "never"]).collect()
    assert len(rows) == 12
    for name, model in models.items():
        mine = {r["feature"]: r for r in rows if r["model"] == name}
        assert mine["never"]["gain"] == 0
        for kind in ("splits", "gain", "cover"):
            assert math.isclose(sum(r[kind] for r in mine.values()), 1.0)
        tests = [f for t in model.node_lists() for f in t["feature"] if f >= 0]
        assert math.isclose(mine["a"]["splits"], tests.count(0) / len(tests))
        assert np.allclose([mine[f]["gain"] for f in FEATURES], model.featureImportances.toArray())


SPACE = {"depth": ("int", 1, 12), "rate": ("logfloat", 1e-3, 1.0), "share": ("float", 0.2, 1.0), "kind": ("choice", ["x", "y", "z"])}


def loss(p):
    return (p["depth"] - 5) ** 2 / 20 + math.log10(p["rate"] / 0.05) ** 2 + (p["share"] - 0.7) ** 2 + (p["kind"] != "y") * 0.5


def test_study_beats_random_draws(spark):
    won = 0
    for seed in range(6):
        trials = []
        for n in range(60):
            p = S.propose(SPACE, n, trials, [], seed)
            assert 1 <= p["depth"] <= 12 and isinstance(p["depth"], int) and 1e-3 <= p["rate"] <= 1.0 and p["kind"] in "xyz" and 0.2 <= p["share"] <= 1
            trials.append(S.Trial(n, p, loss(p)))
        drawn = [S.propose(SPACE, n, [], [], seed + 100) for n in range(60)]
        won += min(t.value for t in trials) < min(map(loss, drawn))
    assert won >= 5


def test_study_resumes_with_the_same_trials(spark):
    def objective(batch):
        return [None if n == 3 else loss(p) for n, p in batch]

    one = S.Study(spark, SPACE, scratch_path(spark, "study"), seed=7, startup=4)
    one.run(objective, 14, at_once=4)
    path = scratch_path(spark, "study")
    S.Study(spark, SPACE, path, seed=7, startup=4).run(objective, 6, at_once=4)
    again = S.Study(spark, SPACE, path, seed=7, startup=4)
    assert len(again.trials) == 6
    again.run(objective, 14, at_once=4)
    # 6 trials end inside a batch, whose rest did not know the values of its beginning
    assert [t.params for t in one.trials[:6]] == [t.params for t in again.trials[:6]]
    whole = S.Study(spark, SPACE, scratch_path(spark, "study"), seed=7, startup=4)
    whole.run(objective, 8, at_once=4)
    more = S.Study(spark, SPACE, whole.path, seed=7, startup=4)
    more.run(objective, 14, at_once=4)
    assert [(t.params, t.value) for t in more.trials] == [(t.params, t.value) for t in one.trials]
    assert one.best.value == min(t.value for t in one.trials if t.value is not None) and one.table().count() == 14
    assert random.Random("7:1").random() == random.Random("7:1").random()
