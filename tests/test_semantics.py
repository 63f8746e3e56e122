"""Hand-made semantic frames (FIXTURES.md section 4) and the traps of
"""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabflow.functions.columns import adjusted_kurtosis, adjusted_skewness, row_mean, row_std
from tabflow.functions.quantiles import quantile_columns
from tabflow.operators import binning, clean, encode, profile, select
from tabflow.sources.scan import read_table


def col(df, c, order="i"):
    return [r[c] for r in df.orderBy(order).collect()]


def test_mode_tie_picks_smallest_and_codes(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, "a"), (4, None)], "i int, c string")
    assert clean.fit_mode(df, "c") == "a"
    assert col(encode.category_codes(df, ["c"]), "c") == [1, 0, 1, 0, -1]


def test_mode_all_null_falls_back(spark):
    df = spark.createDataFrame([(0, None)], "i int, c string")
    assert clean.fit_mode(df, "c", fallback="Medium") == "Medium"


def test_fixed_bins_right_closed_outside_null(spark):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate([0, 1, 69, 70, 270, 271])], "i int, x double")
    out = binning.cut(df, "x", "b", ordinal_out="o")
    assert col(out, "b") == [None, "Low", "Low", "Medium", "Very High", None]
    assert col(out, "o") == [None, 0, 0, 1, 3, None]
    prof = {r["label"]: r["count"] for r in binning.binned_profile(df.withColumn("y", F.lit(1.0)), "x", "y").collect()}
    assert prof == {"Low": 2, "Medium": 1, "High": 0, "Very High": 1}


def test_quantile_bins(spark):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate([1, 1, 2, 3, 4, 5, 6, 7])], "i int, x double")
    out, edges = binning.qcut(df, "x", "b", 4)
    assert col(out, "b") == [0, 0, 1, 1, 2, 2, 3, 3]
    assert edges[0] == 1.0 and edges[-1] == 7.0


def test_quantile_bins_duplicate_edges_raise(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 1, 1, 3]], "x double")
    with pytest.raises(ValueError):
        binning.qcut(df, "x", "b", 4)


def test_null_safe_duplicates(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 2), (None, 2)], "a int, b int")
    assert profile.duplicate_count(df).first()["n_duplicates"] == 2


def test_scan_null_tokens(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("a,b,c\n,1.5,x\nNA,NaN,y\nfoo,2.0,NA\n")
    df = read_table(spark, str(p), schema=__import__("pyspark.sql.types", fromlist=["StructType"]).StructType.fromJson(
        {"type": "struct", "fields": [{"name": "a", "type": "string", "nullable": True, "metadata": {}},
                                      {"name": "b", "type": "double", "nullable": True, "metadata": {}},
                                      {"name": "c", "type": "string", "nullable": True, "metadata": {}}]}))
    rows = df.collect()
    assert [r["a"] for r in rows] == [None, None, "foo"]
    assert [r["b"] for r in rows] == [1.5, None, 2.0]
    assert [r["c"] for r in rows] == ["x", "y", None]


def test_adjusted_skew_kurtosis_match_pandas(spark):
    xs = [1.0, 2.0, 2.0, 3.0, 10.0, 4.0, 7.5, 0.5]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    r = df.agg(adjusted_skewness("x").alias("s"), adjusted_kurtosis("x").alias("k")).first()
    assert math.isclose(r["s"], pd.Series(xs).skew(), rel_tol=1e-9)
    assert math.isclose(r["k"], pd.Series(xs).kurt(), rel_tol=1e-9)


def test_row_stats_skip_nulls(spark):
    df = spark.createDataFrame([(1.0, None, 3.0)], "a double, b double, c double")
    r = df.select(row_mean(["a", "b", "c"]).alias("m"), row_std(["a", "b", "c"]).alias("s")).first()
    assert r["m"] == 2.0 and math.isclose(r["s"], math.sqrt(2.0))


def test_unknown_category_policies(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    test = spark.createDataFrame([(0, "a"), (1, "z"), (2, None)], "i int, c string")
    d = encode.fit_dictionaries(train, ["c"])
    keep = encode.encode(test, "c", d["c"], unknown="keep", missing_token="Missing")
    miss = encode.encode(test, "c", d["c"], unknown="missing", null_code=-1)
    # train has no nulls: a=0, b=1; a null test value becomes the unseen "Missing"
    assert col(keep, "c") == [0, 2, 2]
    assert col(miss, "c") == [0, -1, -1]
    with pytest.raises(Exception):
        encode.encode(test, "c", d["c"], unknown="error").collect()


def test_large_dictionary_uses_join(spark):
    vals = [f"v{i:03d}" for i in range(100)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, c string")
    d = encode.fit_dictionaries(df, ["c"], missing_token=None)
    out = encode.encode(df, "c", d["c"])
    assert col(out, "c") == list(range(100))


def test_fscore_policies(spark):
    df = spark.createDataFrame([(float(i), 1.0, float(i), float(i % 3)) for i in range(10)],
                               "y double, const double, same double, other double")
    s = {r["feature"]: r["f_score"] for r in select.f_scores(df, "y", ["const", "same", "other"]).collect()}
    assert s["const"] == 0.0
    assert s["same"] == select.MAX_F
    assert 0 < s["other"] < select.MAX_F


def test_exact_quantiles_refinement_path(spark):
    rng = np.random.default_rng(1)
    xs = rng.normal(size=5000).round(3)
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    exact = quantile_columns(df, ["x"], probs)["x"]
    forced = quantile_columns(df, ["x"], probs, max_exact_distinct=0, max_collect=50)["x"]
    ref = np.quantile(xs, probs)
    assert np.allclose(exact, ref) and np.allclose(forced, ref)


def test_standardization_counts(spark):
    df = spark.createDataFrame([("LF",), ("Low Fat",), ("reg",), ("Regular",)], "f string")
    out = {r["value"]: (r["before"], r["after"]) for r in
           clean.standardization_counts(df, "f", (("LF", "Low Fat"), ("reg", "Regular"))).collect()}
    assert out == {"LF": (1, 0), "Low Fat": (1, 2), "reg": (1, 0), "Regular": (1, 2)}


def test_global_index_and_large_dictionary_ranking(spark):
    from tabflow.functions.ranking import global_index
    vals = [f"v{i:05d}" for i in range(3000)]
    df = spark.createDataFrame([(v,) for v in reversed(vals)], "value string").repartition(7)
    got = {r["value"]: r["idx"] for r in global_index(df, ["value"]).collect()}
    assert got == {v: i for i, v in enumerate(vals)}
    d = encode.fit_dictionaries(df.withColumnRenamed("value", "c"), ["c"], missing_token=None, literal_limit=10)
    assert d["c"].values is None and d["c"].size == 3000
    codes = {r["k"]: r["v"] for r in d["c"].table.collect()}
    assert codes == {v: i for i, v in enumerate(vals)}


def test_dictionaries_are_bijections(spark):
    from tabflow.roles import FIXTURE_ROLES as R
    from tabflow.sources.tables import sales
    s = sales(spark, "/root/testdata/sf0.001")
    cats = list(R.categoricals)
    dicts = encode.fit_dictionaries(s, cats)
    for c, d in dicts.items():
        assert d.values == sorted(set(d.values))
        assert sorted(d.mapping().values()) == list(range(d.size))


def test_outlier_count_independent_of_row_order(spark):
    from tabflow.operators import quality
    rng = np.random.default_rng(3)
    xs = rng.standard_t(3, size=2000)
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    a = quality.iqr_outliers(df, ["x"]).first()["n_outliers"]
    b = quality.iqr_outliers(df.orderBy(F.rand(5)).repartition(9), ["x"]).first()["n_outliers"]
    q1, q3 = np.quantile(xs, [0.25, 0.75])
    ref = int(((xs < q1 - 1.5 * (q3 - q1)) | (xs > q3 + 1.5 * (q3 - q1))).sum())
    assert a == b == ref


def test_exact_quantiles_refinement_many_columns(spark):
    rng = np.random.default_rng(11)
    a = rng.normal(size=4000).round(2)
    b = rng.exponential(size=4000).round(3)
    c = rng.integers(0, 50, size=4000).astype(float)
    df = spark.createDataFrame([(float(x), float(y), float(z)) for x, y, z in zip(a, b, c)], "a double, b double, c double")
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    got = quantile_columns(df, ["a", "b", "c"], probs, max_exact_distinct=0, max_collect=300)
    for col_name, xs in (("a", a), ("b", b), ("c", c)):
        assert np.allclose(got[col_name], np.quantile(xs, probs)), col_name
