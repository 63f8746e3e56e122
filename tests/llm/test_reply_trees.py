import random

import pytest
from pyspark.sql import functions as F

from tabflow.llm import reply_trees as R


def brute(messages, branches):
    """(tree, leaf, rank) -> nodes from root to leaf."""
    by = {(t, n): (p, s) for t, n, p, s, *_ in messages}
    up = {k: (k[0], p) if (k[0], p) in by else None for k, (p, _) in by.items()}
    leaves = set(by) - {u for u in up.values() if u}
    paths = {}
    for leaf in leaves:
        path = [leaf]
        while up[path[-1]]:
            path.append(up[path[-1]])
        paths.setdefault(path[-1], []).append((-sum(by[k][1] or 0 for k in path), leaf[1], path[::-1]))
    return {(root[0], leaf, rank): [k[1] for k in path] for root, found in paths.items()
            for rank, (_, leaf, path) in enumerate(sorted(found)[:branches], 1)}


@pytest.mark.parametrize("branches", [1, 3])
def test_best_paths_equal_brute_force(spark, branches):
    rng = random.Random(branches)
    rows = []
    for tree in "abcde":
        for n in range(80):
            parent = rng.choice([None, 999, *range(n)]) if n % 9 == 0 else rng.randrange(max(0, n - 4), n)
            rows.append((tree, n, parent, rng.choice([None, 0, 1, 1, 5]), rng.choice(["user", "assistant", None]), f"m{n}"))
    rows += [("long", n, n - 1 if n else None, 1, "user", "x") for n in range(300)]
    df = spark.createDataFrame(rows, "tree string, node long, parent long, score long, role string, text string")
    want = brute(rows, branches)
    got = {}
    for r in R.best_paths(df, branches).collect():
        got.setdefault((r["tree"], r["leaf"], r["rank"]), []).append((r["step"], r["node"]))
    assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == want
    assert all([s for s, _ in sorted(v)] == list(range(len(v))) for v in got.values())
    out = R.format_paths(df, branches).collect()
    texts = {(t, n): (role or "", text) for t, n, _, _, role, text in rows}
    for r in out:
        path = want[r["tree"], r["leaf"], r["rank"]]
        assert r["formatted"] == "".join(f"### {texts[r['tree'], n][0]}: {texts[r['tree'], n][1]}</turn>\n" for n in path)
        learned = [texts[r["tree"], n][1] for n in path if texts[r["tree"], n][0] == "assistant"]
        assert [r["formatted"][s["start"] - 1:s["start"] - 1 + s["length"]] for s in r["loss"]] == learned


def test_circles_are_refused(spark, monkeypatch):
    monkeypatch.setattr(R, "MAX_ROUNDS", 4)
    df = spark.createDataFrame([("a", 1, 2, 1), ("a", 2, 1, 1), ("b", 1, None, 1)], "tree string, node long, parent long, score long")
    with pytest.raises(ValueError):
        R.best_paths(df)


ODD = ["", "\\", "\\\\", "</turn>", "</turn>\n", "### user: x", "a: b", "\\s\\h\\l\\c", "\\h#<:", "é😀 # < \n\n ok\\", ":", "\n", "<", "#### :", "\\</turn>\n### assistant: "]


def test_any_text_comes_back(spark):
    rng = random.Random(0)
    odd = ODD + ["".join(rng.choice("\\#<>:/turnshlc \n") for _ in range(40)) for _ in range(100)] + ["long # text " * 50_000]
    rows = [(i // 5, i % 5, rng.choice(["user", "assistant", "sys:#<\\ \n", ""]), t) for i, t in enumerate(odd)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = R.format_paths(R.as_chain(df)).select("tree", R.read_turns(F.col("formatted")).alias("turns"),
                                                 R.read_loss(F.col("formatted"), F.col("loss")).alias("learned")).collect()
    assert len(out) == len({r[0] for r in rows})
    for r in out:
        own = [(role, text) for c, _, role, text in rows if f"={c}" == r["tree"]]
        assert [tuple(t) for t in r["turns"]] == own
        assert r["learned"] == "".join(text for role, text in own if role == "assistant")


def test_nulls_ties_and_empty(spark):
    rows = [(None, 0, "user", None), (None, 1, None, "x"), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "assistant", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as node", "'z' as tree", "2 as score")
    got = {r["tree"]: [tuple(t) for t in r["turns"]] for r in R.format_paths(R.as_chain(df)).select("tree", R.read_turns(F.col("formatted")).alias("turns")).collect()}
    assert got == {"": [("user", ""), ("", "x")], "=1": [("assistant", "n"), ("user", "a"), ("user", "a"), ("user", "b")]}
    out = R.format_paths(R.as_chain(df.limit(0)))
    assert out.count() == 0
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
