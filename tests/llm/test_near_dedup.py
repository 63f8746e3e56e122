import random
import re

import numpy as np
import pytest

from tabflow.llm import links as links_module
from tabflow.llm import near_dedup as N
from tabflow.llm.links import components, linked

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """id -> smallest id reachable; rows of one id are one document."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return {i: top(i) for i in root}


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    rows = [say(rng.randrange(0, 80)) for _ in range(40)]
    base, chain = say(60), say(50)
    for _ in range(60):                       # a large group of near copies
        copy = list(base)
        copy[rng.randrange(60)] = rng.choice(vocab)
        rows.append(copy)
    for _ in range(12):                       # a chain of edits: the ends are not alike
        chain = list(chain)
        chain[rng.randrange(50)] = rng.choice(vocab)
        rows.append(chain)
    passage = say(30)                         # a passage that unlike documents share
    rows += [passage + say(rng.randrange(5, 60)) for _ in range(40)]
    rows += [base] * 20 + [["one"], ["ONE"], ["two", "words"], []]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return [(i, rng.choice([" ", "\n", " \t "]).join(r)) for i, r in zip(ids, rows)]


def check(rows, got):
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["component_id"], r["kept"]) == (want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])


def test_components_equal_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, id string, key int")
        got = N.near_duplicates(df).collect()
        check(rows, got)
        assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(shingles(t)) for i, t in rows}


def test_long_lists_are_posted_anew_without_loss(spark, monkeypatch):
    monkeypatch.setattr(N.post_long_lists_anew, "__defaults__", (3,))
    rows = corpus(3)
    check(rows, N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_nulls_blanks_ties_and_repeated_rows(spark):
    long = " ".join(f"v{i % 997}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b c d e f"), (None, None), (4, "a b c d e f"), (4, "a b c d e f"),
            (5, "other text that is quite long indeed"), (4, "other text that is quite long indeed"), (6, long), (7, long + " end"), (8, "a b c d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = N.near_duplicates(df).collect()
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], set()).add((r["component_id"], r["kept"]))
    assert by_id == {1: {(1, True)}, 2: {(2, True)}, 3: {(3, True)}, None: {(None, True)}, 4: {(4, True)}, 5: {(4, False)},
                     6: {(6, True)}, 7: {(6, False)}, 8: {(4, False)}}
    kept = N.keep_one(df.selectExpr("doc_id", "text", "1 as rep", "2 as __n")).collect()
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 0, 1, 2, 3, 4, 6]
    assert N.near_duplicates(df.limit(0)).count() == 0
    assert N.keep_one(df.limit(0)).count() == 0


def test_least_matches_is_the_binomial_tail():
    rng = np.random.default_rng(0)
    least = N.least_matches(64)
    assert (rng.binomial(64, 0.75, 1_000_000) >= least).mean() > 1 - 1e-5


@pytest.mark.parametrize("few,salt", [(200_000, 20_000), (0, 3)])
def test_linked_loses_no_link(spark, monkeypatch, few, salt):
    """Random lists and links against all pairs of each list, with broadcasts and with salted shuffles."""
    monkeypatch.setattr(links_module, "FEW", few)
    monkeypatch.setattr(links_module, "ROWS_A_SALT", salt)
    rng = random.Random(5)
    lists = {k: rng.sample(range(60), rng.choice([2, 5, 30])) for k in range(25)}
    links = {tuple(sorted(rng.sample(range(60), 2))) for _ in range(60)}
    postings = spark.createDataFrame([(k, i, 1, 1) for k, ids in lists.items() for i in ids], "key long, id long, n long, rest long")
    known = spark.createDataFrame(sorted(links), "a long, b long")
    _, got = linked(postings, lambda pairs, n: pairs.join(known, ["a", "b"]), anchors=2)
    listed = {p for ids in lists.values() for p in links if p[0] in ids and p[1] in ids}
    root = {i: i for i in range(60)}
    for _ in range(60):
        for a, b in listed:
            root[a] = root[b] = min(root[a], root[b])
    found = {r["id"]: r["component"] for r in got.collect()}
    assert {i: found.get(i, i) for i in root} == root


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(500, 900), (900, 700)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(edges)[0].collect()}
    assert got == {**{i: 0 for i in range(301)}, 500: 500, 700: 500, 900: 500}
