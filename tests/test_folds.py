"""Equal folds, selection inside folds, comparison of stored predictions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabflow.models import linear
from tabflow.models.folds import equal_folds
from tabflow.models.scoring import compare_stored_predictions
from tabflow.operators.select import fold_f_scores


@pytest.mark.parametrize("n,k", [(1003, 7), (5, 8), (0, 3)])
@pytest.mark.parametrize("shuffle", [True, False])
def test_sizes_differ_by_one_row(spark, n, k, shuffle):
    df = spark.range(n).withColumn("fold", F.lit("kept over"))
    sizes, members = None, None
    for rows_per_range in (250_000, 40):
        got = equal_folds(df, k, ["id"], shuffle=shuffle, out="f", rows_per_range=rows_per_range).collect()
        assert len(got) == n and all(0 <= r["f"] < k for r in got) and all(r["fold"] == "kept over" for r in got)
        now = {r["id"]: r["f"] for r in got}
        assert members in (None, now)
        members = now
        sizes = np.bincount(list(now.values()), minlength=k) if n else np.zeros(k, int)
        assert sizes.max() - sizes.min() <= 1 and list(sizes) == sorted(sizes, reverse=True)
    if n > 100:
        by_id = [members[i] for i in range(n)]
        assert (by_id == sorted(by_id)) != shuffle
        other = {r["id"]: r["f"] for r in equal_folds(df, k, ["id"], seed=7, shuffle=shuffle, out="f").collect()}
        assert (other == members) != shuffle


def test_selection_sees_training_rows_only(spark):
    rng = np.random.default_rng(0)
    n = 300
    x, fold = rng.normal(size=(n, 3)), np.arange(n) % 3
    y = x[:, 0] + 0.9 * x[:, 1] + 0.1 * rng.normal(size=n)
    # in fold 1 the second feature is the target: outside it the first is better
    y[fold == 1] = 20 * x[fold == 1, 1]
    df = spark.createDataFrame([(*map(float, x[i]), float(y[i]), int(fold[i])) for i in range(n)], "a double, b double, c double, y double, fold int")
    got = {(r["fold"], r["feature"]): r for r in fold_f_scores(df, "y", "fold", 1, ["a", "b", "c"]).collect()}
    for f in range(3):
        rows = fold != f
        r = [np.corrcoef(x[rows, i], y[rows])[0, 1] for i in range(3)]
        for i, name in enumerate("abc"):
            assert np.isclose(got[f, name]["correlation"], r[i]) and np.isclose(got[f, name]["f_score"], r[i] ** 2 / (1 - r[i] ** 2) * (rows.sum() - 2))
            assert got[f, name]["selected"] == (i == int(np.argmax(np.abs(r))))
    assert got[1, "a"]["selected"] and got[0, "b"]["selected"]
    fm, sol = linear.cv_linear(df, ["a", "b", "c"], "y", "fold", [linear.LinearConfig("m", "ols")], select_k=1)
    for r in fm.collect():
        rows = fold != r["fold"]
        best = 0 if r["fold"] == 1 else 1
        slope, cut = np.polyfit(x[rows, best], y[rows], 1)
        e = cut + slope * x[~rows, best] - y[~rows]
        assert np.isclose(r["rmse"], np.sqrt((e * e).mean())) and np.isclose(r["mae"], np.abs(e).mean())


def test_stored_predictions_missing_and_repeated_keys(spark):
    a = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("y", 5.0), (None, 7.0)], "id string, prediction double")
    b = spark.createDataFrame([("x", 4.0), ("z", 6.0), ("y", None)], "id string, prediction double")
    got = {r["id"]: r.asDict() for r in compare_stored_predictions({"a": a, "b": b}, "id").collect()}
    assert set(got) == {"x", "y", "z", None}
    assert (got["x"]["rows_a"], got["x"]["pred_a"], got["x"]["pred_b"], got["x"]["pred_mean"]) == (2, 2.0, 4.0, 3.0)
    assert (got["z"]["rows_a"], got["z"]["pred_a"], got["z"]["pred_mean"]) == (0, None, 6.0)
    assert got["y"]["rows_b"] == 1 and got["y"]["pred_b"] is None and got[None]["pred_a"] == 7.0
