"""The paths that only large inputs take, forced on small ones, and inputs that the fixture does not hold."""

import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabflow import session
from tabflow.functions import lookup
from tabflow.functions.quantiles import group_quantiles, quantile_columns
from tabflow.functions.ranking import global_index
from tabflow.models import ensemble as E
from tabflow.models import linear
from tabflow.models import search as S
from tabflow.operators import encode, profile
from tabflow.plans import catalog, features
from tabflow.plans.features import FeaturePipeline, FeaturePipelineModel
from tabflow.roles import FIXTURE_ROLES as R
from tabflow.sources.scan import load_data, read_table
from tabflow.sources import tables
from tabflow.sources.tables import sales

SF = "/root/testdata/sf0.001"
PLANS = [{}, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}, {"spark.sql.adaptive.enabled": "false"},
         {"spark.sql.exchange.reuse": "false"}]


@pytest.mark.parametrize("conf", PLANS)
@pytest.mark.parametrize("payload", [False, True])
def test_positions_do_not_depend_on_the_plan(spark, conf, payload):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    df = li.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("k"), *(["l_extendedprice"] if payload else []))
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        runs = [{r["k"]: r["idx"] for r in global_index(df, ["k"], rows_per_range=200).collect()} for _ in range(2)]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    keys = sorted(r["k"] for r in df.collect())
    assert runs[0] == runs[1] == {k: i for i, k in enumerate(keys)}


def test_positions_of_several_columns_and_integers(spark):
    rows = [(c, v) for c in "abc" for v in range(0, 999, 3)]
    df = spark.createDataFrame(rows, "c string, v int").repartition(5)
    assert [tuple(r)[:2] for r in sorted(global_index(df, ["c", "v"], rows_per_range=50).collect(), key=lambda r: r["idx"])] == sorted(rows)
    assert global_index(df.limit(0), ["c"]).count() == 0


def test_large_dictionary_survives_aggregates(spark):
    df = spark.range(30_000).select(F.concat(F.lit("k"), F.col("id")).alias("c"), (F.col("id") * 2).alias("x"))
    d = encode.fit_dictionaries(df, ["c"], missing_token=None, literal_limit=10)["c"]
    assert d.table.agg(F.count("v"), F.countDistinct("v"), F.max("v")).first()[:] == (30_000, 30_000, 29_999)


def test_quantiles_on_a_tie_border(spark):
    df = spark.createDataFrame([(float(i % 2),) for i in range(2000)] + [(0.5,)], "x double")
    xs = [float(i % 2) for i in range(2000)] + [0.5]
    probs = [0.0, 0.1, 0.4999, 0.5, 0.5001, 0.9, 1.0]
    got = quantile_columns(df, ["x"], probs, max_exact_distinct=1, max_collect=100)["x"]
    assert np.allclose(got, np.quantile(xs, probs))


def test_group_quantiles_and_null_groups(spark):
    rng = np.random.default_rng(2)
    data = {"a": rng.normal(size=700).round(1), "b": rng.integers(0, 3, 50).astype(float), "c": np.array([4.0])}
    rows = [(g, float(x)) for g, xs in data.items() for x in xs] + [(None, 1.0), ("a", None), ("d", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r["p"] for r in group_quantiles(df, "x", "g", [0.0, 0.25, 0.5, 1.0], rows_per_range=20).collect()}
    assert set(got) == set(data) and all(np.allclose(got[g], np.quantile(xs, [0.0, 0.25, 0.5, 1.0])) for g, xs in data.items())
    small, large = (sorted(profile.box_stats(df, "x", "g", max_group_distinct=n).where("q1 is not null").collect(), key=lambda r: r["g"]) for n in (10 ** 6, 1))
    assert small == large and [r["g"] for r in small] == ["a", "b", "c"]
    assert profile.box_stats(df, "x", "g").where("g is null").count() == 0


def test_qq_line_over_all_order_statistics(spark):
    rng = np.random.default_rng(4)
    xs = np.sort(rng.normal(3, 2, 500).round(1))
    got = profile.qq_table(spark.createDataFrame([(float(x),) for x in xs] + [(None,)], "x double"), "x").orderBy("sample").collect()
    chunked = profile.qq_table(spark.createDataFrame([(float(x),) for x in xs] + [(None,)], "x double"), "x", chunk=3).orderBy("sample").collect()
    assert [r["sample"] for r in chunked] == [r["sample"] for r in got]
    assert np.allclose([[r[c] for c in ("theoretical", "slope", "intercept", "r")] for r in chunked], [[r[c] for c in ("theoretical", "slope", "intercept", "r")] for r in got])
    n = len(xs)
    p = np.array([1 - 0.5 ** (1 / n), *((np.arange(2, n) - 0.3175) / (n + 0.365)), 0.5 ** (1 / n)])
    t = np.array([NormalDist().inv_cdf(v) for v in p])
    slope, intercept = np.polyfit(t, xs, 1)
    assert sum(r["count"] for r in got) == n
    assert math.isclose(got[0]["slope"], slope, rel_tol=1e-9) and math.isclose(got[0]["intercept"], intercept, rel_tol=1e-9)
    assert math.isclose(got[0]["r"], np.corrcoef(t, xs)[0, 1], rel_tol=1e-9)
    for r in got[:20]:
        assert math.isclose(r["theoretical"], t[xs == r["sample"]].mean(), rel_tol=1e-9, abs_tol=1e-12)


def test_duplicates_by_digest_keep_nulls_and_borders_apart(spark):
    rows = [("a", "bc"), ("ab", "c"), (None, "x"), (None, "x"), ("", "x"), ("1:a", "n"), ("1:a", "n"), ("1:a", "n"), ("n", None)]
    df = spark.createDataFrame(rows, "a string, b string")
    assert tuple(profile.duplicate_count(df).first()) == (3, 2)
    assert sorted(((r["a"] or "-", r["b"]), r["count"]) for r in profile.duplicate_groups(df).collect()) == [(("-", "x"), 2), (("1:a", "n"), 3)]


@pytest.fixture(scope="module")
def gaps(spark):
    rng = np.random.default_rng(1)
    rows = [(i % 4, float(x) if i % 3 else None, float(2 * x + 1)) for i, x in enumerate(rng.normal(1e6, 1, 400))]
    return spark.createDataFrame(rows, "fold int, x double, y double")


def test_null_features_fail_with_their_count(gaps):
    for fit in (lambda: S.cross_validate(gaps, [S.Candidate("o", "linear_ols", {"kind": "ols"})], ["x"], "y"),
                lambda: S.cross_validate(gaps, [S.Candidate("t", "decision_tree", {"maxDepth": 2})], ["x"], "y"),
                lambda: E.fit_candidate(gaps, S.Candidate("t", "decision_tree", {"maxDepth": 2}), ["x"], "y"),
                lambda: linear.fit_linear(gaps, ["x"], "y", linear.LinearConfig("o"))):
        with pytest.raises(ValueError, match="134 rows"):
            fit()
    fm = S.cross_validate(gaps, [S.Candidate("o", "linear_ols", {"kind": "ols"})], ["x"], "y", on_null="drop")
    assert fm.agg(F.sum("n")).first()[0] == 266 and fm.agg(F.max("rmse")).first()[0] < 1e-4


def test_wide_moments_and_metrics(spark):
    rng = np.random.default_rng(5)
    n, d = 900, 300
    x = rng.normal(size=(n, d)) + 1000
    y = x @ rng.normal(size=d) + rng.normal(size=n)
    names = [f"f{i}" for i in range(d)]
    df = spark.createDataFrame([(i % 3, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], ["fold", *names, "y"])
    fm, _ = linear.cv_linear(df, names, "y", "fold", [linear.LinearConfig("r", "ridge", 10.0), linear.LinearConfig("m", "mean")])
    for r in fm.collect():
        held = np.arange(n) % 3 == r["fold"]
        a, b = x[~held], y[~held]
        if r["model"] == "m":
            e = y[held] - b.mean()
        else:
            mean, std = a.mean(0), a.std(0)
            z = (a - mean) / std
            w = np.linalg.solve(z.T @ z + 10.0 * np.eye(d), z.T @ (b - b.mean()))
            e = y[held] - ((x[held] - mean) / std @ w + b.mean())
        assert math.isclose(r["rmse"], math.sqrt((e ** 2).mean()), rel_tol=1e-6)
        assert math.isclose(r["mae"], np.abs(e).mean(), rel_tol=1e-6)
        assert math.isclose(r["r2"], 1 - (e ** 2).sum() / ((y[held] - y[held].mean()) ** 2).sum(), rel_tol=1e-5, abs_tol=1e-6)


def test_solvers_equal_the_library(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 4)) * [1, 3, 0.5, 2]
    y = x @ [1.5, 0.0, -2.0, 0.3] + rng.normal(size=500) * 0.2
    names = list("abcd")
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], [*names, "y"])
    vec = VectorAssembler(inputCols=names, outputCol="v").transform(df)
    for cfg, reg, mix in ((linear.LinearConfig("o", "ols", scale=False), 0.0, 0.0),
                          (linear.LinearConfig("r", "ridge", 0.4 * 500, scale=False), 0.4, 0.0),
                          (linear.LinearConfig("l", "lasso", 0.3, scale=False), 0.3, 1.0),
                          (linear.LinearConfig("e", "enet", 0.3, 0.5, scale=False), 0.3, 0.5)):
        # the library divides the target by its deviation; the penalty is scaled to the same problem
        sd = float(np.std(y, ddof=1))
        own = linear.fit_linear(df, names, "y", cfg)
        lib = LinearRegression(featuresCol="v", labelCol="y", regParam=reg, elasticNetParam=mix, standardization=False, tol=1e-12, maxIter=1000,
                               solver="l-bfgs" if mix else "normal").fit(vec)
        w, v = np.array(own.getOrDefault("coefficients")), lib.coefficients.toArray()
        if cfg.kind in ("ridge", "enet"):
            # ridge penalties differ by the library's inner scaling: compare objectives instead of weights
            alpha = cfg.alpha / (500 if cfg.kind == "ridge" else 1)
            l1, l2 = (0.0, alpha) if cfg.kind == "ridge" else (alpha * 0.5, alpha * 0.5)

            def loss(u):
                e = y - y.mean() - (x - x.mean(0)) @ u
                return (e @ e) / 1000 + l1 * np.abs(u).sum() + l2 / 2 * (u @ u)

            assert loss(w) <= loss(v) + 1e-9
            assert all(loss(w) <= loss(w + s) + 1e-12 for s in rng.normal(size=(50, 4)) * 1e-3)
        else:
            assert np.allclose(w, v, atol=1e-5 * sd), cfg.kind


def test_new_outlets_and_prices_always_get_values(spark):
    s = sales(spark, SF)
    m = FeaturePipeline(R, unknown="missing").fit(s.where("split = 'train'"))
    new = s.where("split = 'test'").withColumns({"outlet_id": F.lit("NEW"), "price": F.col("price") * 10})
    out = m.transform(new)
    assert out.where("visibility_outlet_mean is null or visibility_ratio is null or price_category is null").count() == 0


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_large_outlet_table_is_reloaded_from_any_path(spark, tmp_path, monkeypatch, scheme):
    monkeypatch.setattr(features, "SMALL_TABLE", 2)
    s = sales(spark, SF)
    m = FeaturePipeline(R, unknown="missing").fit(s.where("split = 'train'"))
    assert m.stats.outlet_table is not None
    path = f"{scheme}{tmp_path}/model"
    m.write().overwrite().save(path)
    test = s.where("split = 'test'")
    assert sorted(FeaturePipelineModel.load(path).transform(test).collect()) == sorted(m.transform(test).collect())


@pytest.mark.parametrize("entries", [0, 32])
def test_ids_need_not_be_strings(spark, monkeypatch, entries):
    monkeypatch.setattr(lookup, "LITERAL_ENTRIES", entries)
    s = sales(spark, SF).withColumn("outlet_id", F.col("l_suppkey") % 10)
    out = FeaturePipeline(R).fit(s).transform(s)
    assert out.where("visibility_outlet_mean is null").count() == 0
    assert out.select("visibility_outlet_mean").distinct().count() == 10


def test_strings_of_typed_formats_stay(spark, tmp_path):
    df = spark.createDataFrame([("NA", 1.0), ("None", float("nan")), (None, 2.0)], "country string, x double")
    df.write.parquet(str(tmp_path / "t"))
    assert sorted((r["country"] or "", r["x"] or 0.0) for r in read_table(spark, str(tmp_path / "t")).collect()) == [("", 2.0), ("NA", 1.0), ("None", 0.0)]


def test_inputs_are_found_by_uri_and_glob(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a.parquet"))
    for path in (f"file://{tmp_path}/a.parquet", f"{tmp_path}/*.parquet", str(tmp_path / "a.parquet")):
        assert load_data(spark, path, path)[0].count() == 3
    assert load_data(spark, f"file://{tmp_path}/a.parquet", f"file://{tmp_path}/none.parquet") == (None, None)


def test_types_are_found_after_null_tokens(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c,d,e\n1,NA,x,true,2020-01-02 03:04:05\nNA,2.5,n/a,FALSE,\n3,,N,NULL,NaN\n")
    df = read_table(spark, str(tmp_path / "t.csv"))
    assert [t for _, t in df.dtypes] == ["bigint", "double", "string", "boolean", "timestamp_ntz"]
    assert [tuple(r)[:4] for r in df.collect()] == [(1, None, "x", True), (None, 2.5, None, False), (3, None, "N", None)]


def test_cluster_without_shared_folder_is_an_error():
    class Session:
        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session)


def test_tuning_folds_and_evaluation_folds(spark):
    df = spark.range(300).select(F.expr("id % 3").cast("int").alias("t"), F.expr("id % 5").cast("int").alias("f"), (F.col("id") % 7).cast("double").alias("x"),
                                 ((F.col("id") % 7) * 2.0 + F.sin("id")).alias("y"))
    cands = [S.Candidate("r1", "linear_ridge", {"kind": "ridge", "alpha": 1.0}), S.Candidate("r9", "linear_ridge", {"kind": "ridge", "alpha": 900.0}),
             S.Candidate("t1", "decision_tree", {"maxDepth": 1}), S.Candidate("t4", "decision_tree", {"maxDepth": 4})]
    trials, evaluated, fm = S.tune_and_evaluate(df, cands, ["x"], "y", "t", "f")
    assert trials.count() == 4 and {r["model"] for r in evaluated.collect()} == {"r1", "t4"}
    assert {r["fold"] for r in fm.collect()} == set(range(5))
    assert {r["model"]: r["use_scaling"] for r in trials.collect()} == {"r1": True, "r9": True, "t1": False, "t4": False}


def _lines_and_parts(spark, folder):
    """Lines with unknown, null and repeated part keys."""
    lines = [(i, i % 3, None if i % 11 == 0 else i % 23, i % 7, 10.0 + i, float(i % 5), i % 4 / 10) for i in range(200)]
    parts = [(k, f"type {k % 3}", 900.0 + k) for k in range(20)] + [(5, "type 9", 950.0), (None, "type 0", 901.0)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, "
                                 "l_quantity double, l_discount double").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_type string, p_retailprice double").write.parquet(f"{folder}/part.parquet")
    return str(folder)


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_stored_view_has_the_rows_of_the_lazy_one(spark, tmp_path, broadcast_rows):
    sf = _lines_and_parts(spark, tmp_path)
    stored, lazy = tables.stored_sales(spark, sf, broadcast_rows), sales(spark, sf)
    assert stored.schema == lazy.schema
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, lazy.collect()))


def test_eda_run_sends_part_once_not_with_every_pass(spark, tmp_path, monkeypatch):
    sf = _lines_and_parts(spark, tmp_path)
    seen, joined = [], []
    monkeypatch.setattr(catalog._modeling, "run_eda_and_features", lambda train, test, *_: seen.extend([train, test]) or {"validation": train})
    lines = tables._lines
    monkeypatch.setattr(tables, "_lines", lambda *args: joined.append(lines(*args)) or joined[-1])
    catalog.eda_feature_run(spark, sf)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert len(joined) == 1 and "Join" in plan(joined[0])
    assert len(seen) == 2 and not any("Join" in plan(df) or "Broadcast" in plan(df) for df in seen)
    # a part table above the bound is never broadcast, however small its file is
    tables.stored_sales(spark, sf, broadcast_rows=0)
    assert "SortMergeJoin" in plan(joined[1]) and "Broadcast" not in plan(joined[1])
