import random
import re

import numpy as np
import pytest

from tabflow.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    """doc position -> (n_words, hit positions, item ids)."""
    out = []
    for text in docs:
        w, hit, ids = words(text), set(), set()
        for name, item in items:
            v = words(item)
            n = min(10, len(v))
            grams = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else set()
            for i in range(len(w) - n + 1 if n else 0):
                if tuple(w[i:i + n]) in grams:
                    hit |= set(range(i, i + n))
                    ids.add("null" if name is None else str(name))
        out.append((len(w), hit, sorted(ids)))
    return out


def test_wavelet_matrix():
    rng = np.random.default_rng(0)
    seq = rng.integers(0, 37, 1000)
    tree = D.WaveletMatrix(seq, 37)
    at = rng.integers(0, 1001, 500)
    symbol = rng.integers(0, 37, 500)
    assert tree.rank(symbol, at).tolist() == [int((seq[:i] == s).sum()) for s, i in zip(symbol, at)]
    at = np.arange(1000)
    got, rank = tree.access(at)
    assert (got == seq).all() and rank.tolist() == [int((seq[:i] == seq[i]).sum()) for i in at]


@pytest.mark.parametrize("symbols", [1, 2, 5])
def test_index_counts_and_locates(symbols):
    rng = np.random.default_rng(symbols)
    parts = [rng.integers(1, symbols + 1, n) for n in (1, 3, 50, 7, 50, 200)]
    parts += [parts[2], parts[5]]
    seq = np.concatenate([np.append(p, 0) for p in parts])
    order = D.suffix_array(seq)
    ends = np.append(np.nonzero(seq == 0)[0], len(seq))
    key = lambda i: [*((1, s) for s in seq[i:ends[np.searchsorted(ends, i)]]), (0, np.searchsorted(ends, i))]
    assert order.tolist() == sorted(range(len(seq)), key=key)
    index = D.FMIndex(seq, symbols + 1)
    lengths = rng.integers(1, 6, 60)
    patterns = np.zeros((60, 5), np.int64)
    for r, n in enumerate(lengths):
        patterns[r, :n] = rng.integers(1, symbols + 1, n)
    low, high = index.search(patterns, lengths)
    for p, n, a, b in zip(patterns, lengths, low, high):
        want = [i for i in range(len(seq) - n + 1) if (seq[i:i + n] == p[:n]).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def cases(seed):
    rng = random.Random(seed)
    vocab = ["ab", "cd", "é", "x1", "zz", "q", "w"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, say(rng.choice([0, 1, 3, 9, 10, 11, 30]))) for i in range(12)] + [(3, "q q q q"), (None, say(10)), (99, None), (100, "!!")]
    docs = [say(rng.randrange(0, 60)) for _ in range(40)] + [None, "", "...", "unknown words only"]
    docs += [say(5) + " UNKNOWN " + (items[k][1] or "").upper() + ", " + say(3) for k in range(12)]
    docs += [docs[5], docs[5], say(30_000)]
    return docs, items


@pytest.mark.parametrize("seed,block", [(1, 1 << 20), (2, 40), (3, 200)])
def test_report_equals_brute_force(spark, seed, block):
    docs, items = cases(seed)
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(docs)], "doc_id long, text string, edges string, id int")
    b = spark.createDataFrame(items + items[:2], "item_id long, text string")
    got = {r["doc_id"]: r for r in D.report(d, b, block_bytes=block).collect()}
    assert len(got) == len(docs)
    for i, (n, hit, ids) in enumerate(brute(docs, items)):
        r = got[i]
        assert (r["n_words"], r["items"]) == (n, ids)
        spans = [(s["start"], s["stop"]) for s in r["spans"]]
        assert {p for a, z in spans for p in range(a, z)} == hit
        assert all(z <= a for (_, z), (a, _) in zip(spans, spans[1:]))


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_remove_leaves_no_window_and_clean_rows_alone(spark, block):
    docs, items = cases(4)
    items = [(n, t) for n, t in items if t is None or len(words(t)) >= 9]
    d = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(docs)], "doc_id long, text string, id string, c0 int")
    b = spark.createDataFrame(items, "item_id long, text string")
    out = D.remove(d, b, block_bytes=block)
    assert out.columns == d.columns
    got = {r["doc_id"]: r for r in out.collect()}
    before, after = brute(docs, items), brute([got[i]["text"] for i in range(len(docs))], items)
    for i, text in enumerate(docs):
        assert not after[i][1]
        assert got[i]["id"] == "x" and got[i]["c0"] == i
        if not before[i][1]:
            assert got[i]["text"] == text
    assert any(x[1] for x in before)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c"), (None, None)], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert sorted((r["n_words"], len(r["spans"]), len(r["items"])) for r in D.report(d, b).collect()) == [(0, 0, 0), (3, 0, 0)]
    assert D.report(d.limit(0), b).count() == 0
    assert D.remove(d, b).where("text = 'a b c'").count() == 1
    assert D.remove(d.limit(0), b).count() == 0
