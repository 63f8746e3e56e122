"""Packed blocks: quantiles counted over them, and one packing for all cross-validations of a search."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabflow.models import blocks as B
from tabflow.models import boosting as G
from tabflow.models import search as S
from tabflow.models import subtrees


@pytest.fixture(scope="module")
def frame(spark):
    return spark.range(600).select(F.expr("cast(id % 3 as int)").alias("t"), F.expr("cast(id % 4 as int)").alias("f"), F.sin("id").alias("x"),
                                   F.expr("cast(id % 5 as double)").alias("z"), (F.sin("id") * 3 + F.col("id") % 5).alias("y")).repartition(3)


def test_cuts_are_quantiles_of_all_rows(spark):
    rng = np.random.default_rng(3)
    n = 4000
    x = np.stack([rng.normal(size=n), np.exp(rng.normal(size=n) * 50) * rng.choice([-1, 1], n), rng.integers(-2, 3, n) * 0.1, np.where(rng.random(n) < 0.8, 0.0, rng.random(n))])
    df = spark.createDataFrame([(*map(float, r), 1.0) for r in x.T], "a double, b double, c double, d double, y double").repartition(5)
    for bins in (2, 32, 256):
        packed = B.pack(df, list("abcd"), "y", bins=bins)
        for values, cuts in zip(np.sort(x), packed.cuts):
            want = np.unique([values[max(1, math.ceil(i / bins * n)) - 1] for i in range(bins)])
            assert np.array_equal(cuts, want[want < values[-1]][-(bins - 1):])
        B.discard(packed.table)


def test_ordered_numbers():
    x = np.array([-np.inf, -5.0, -1e-300, -0.0, 0.0, 1e-300, 3.0, np.inf, np.nan])
    keys = B._ordered(x)
    assert keys[3] == keys[4] and (np.delete(keys, 3)[1:] > np.delete(keys, 3)[:-1]).all()
    assert np.array_equal([B._double(int(k)) for k in keys], x, equal_nan=True)


def test_a_search_packs_its_table_once(frame, monkeypatch, tmp_path):
    packed, pack = [], B.pack
    monkeypatch.setattr(B, "pack", lambda *a, **k: packed.append(a) or pack(*a, **k))
    cands = [S.Candidate(f"d{k}", "decision_tree", {"maxDepth": k}) for k in (1, 3)]
    _, evaluated, fm = S.tune_and_evaluate(frame, cands, ["x", "z"], "y", "t", "f")
    assert len(packed) == 1 and {(r["fold"], r["n"]) for r in fm.collect()} == {(k, 150) for k in range(4)}
    alone = {r["fold"]: r["rmse"] for r in S.cross_validate(frame, cands[1:], ["x", "z"], "y", "f").collect()}
    assert all(np.isclose(r["rmse"], alone[r["fold"]]) for r in fm.collect())
    packed.clear()
    space = {"n_estimators": ("int", 1, 2), "max_depth": ("int", 1, 2)}
    found = S.study(frame, "boosted_depth", space, ["x", "z"], "y", "t", str(tmp_path / "study"), 4, at_once=2)
    assert len(found.trials) == 4 and len(packed) == 1


@pytest.mark.parametrize("growth", ["depth", "symmetric"])
def test_a_round_takes_a_pass_a_split_level(frame, monkeypatch, growth):
    """The last level's sums come from the parents, and passes walk no finished trees."""
    told, count = [], G._count_pass
    monkeypatch.setattr(G, "_count_pass", lambda table, work, *a: told.append(work) or count(table, work, *a))
    packed = B.pack(frame, ["x", "z"], "y", "t")
    jobs = [(G.BoostParams(growth, rounds=3, max_depth=k, learning_rate=0.5), f) for k in (2, 3) for f in (0, 1)]
    fitted = G.train(packed, jobs)
    assert len(told) == 9 and not any(since for work in told for _, _, since, _ in work)
    for f in fitted:
        for t in f.trees:
            inner = [n for n, c in enumerate(t.feature) if c >= 0]
            assert all(np.isclose(t.rows[n], t.rows[t.left[n]] + t.rows[t.right[n]]) for n in inner)


def test_runs_counted_or_sorted(monkeypatch):
    rng = np.random.default_rng(5)
    key, g = rng.integers(0, 50, 400), rng.normal(size=400)
    dense = subtrees._runs(key, g, 60)
    monkeypatch.setattr(subtrees, "DENSE", 0)
    for a, b in zip(dense, subtrees._runs(key, g, 60)):
        assert np.allclose(a, b)


def test_written_blocks_lie_in_small_row_groups(spark, frame, monkeypatch):
    """A writer or a reader holds a row group: a few blocks, however many a task writes (Parquet measures every hundred rows only)."""
    import pyarrow.parquet as pq

    monkeypatch.setattr(B, "BLOCK_ROWS", 100)
    monkeypatch.setattr(B, "GROUP_BYTES", 4096)
    sizes, written = {}, B._written

    def measured(df, name):
        table = written(df, name)
        for f in table.inputFiles():
            meta = pq.ParquetFile(f.removeprefix("file://")).metadata
            sizes.setdefault(name, []).extend(meta.row_group(i).num_rows for i in range(meta.num_row_groups))
        return table

    monkeypatch.setattr(B, "_written", measured)
    rows = spark.range(5000).select(F.sin("id").alias("x"), F.cos("id").alias("z"), F.sin(F.col("id") * 2).alias("y")).coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        packed = B.pack(rows, ["x", "z"], "y", raw=True)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    G.train(packed, [(G.boost_params("depth", {"n_estimators": 3, "max_depth": 2}), None)])
    assert set(sizes) == {"raw-blocks", "blocks", "margins"}
    # 2,400 and more bytes a block
    blocks = [r["n"] for r in packed.table.select("n").collect()]
    assert sum(blocks) == 5000 and len(blocks) > 20
    assert all(max(n) <= 2 and sum(n) % len(blocks) == 0 for n in sizes.values()), (len(blocks), {k: sorted(n) for k, n in sizes.items()})


def test_executors_do_not_hold_the_rows_while_trees_grow(frame, monkeypatch):
    """Only searches that read the rows again, or pack them again, keep them."""
    tree, other = S.Candidate("t", "decision_tree", {"maxDepth": 2}), S.Candidate("o", "decision_tree", {"maxDepth": 2, "maxBins": 16})
    exact, ols = S.Candidate("e", "exact_tree", {"max_depth": 2}), S.Candidate("l", "linear_ols", {"kind": "ols"})
    held, get = [], B.Packs.get
    monkeypatch.setattr(B.Packs, "get", lambda self, *a, **k: (get(self, *a, **k), held.append(self.df.is_cached))[0])
    for cands, cached in (([tree], False), ([exact], False), ([tree, other], True), ([tree, exact], True), ([tree, ols], True)):
        held.clear()
        found = S.cross_validate(frame, cands, ["x", "z"], "y", "t")
        assert set(held) == {cached} and found.count() == 3 * len(cands)
