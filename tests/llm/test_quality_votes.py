import random
import zlib

import numpy as np
import pytest

from tabflow.llm import quality_votes as Q
from tabflow.llm.queries import op12_quality_votes

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    got = {r["doc_id"]: r for r in op12_quality_votes(spark, SF).collect()}
    assert set(got) == ids and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    told = [(labels[i], got[i]["predicted"]) for i in labels if got[i]["held_out"]]
    assert len(told) > 80
    for kind in (0, 1):
        assert np.mean([p == kind for y, p in told if y == kind]) > 0.9


def texts(rng, n):
    for i in range(n):
        words = ["".join(rng.choice("aeioustrn") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(5, 60))]
        yield i, i % 2, " ".join(words if i % 2 else [w.upper() + "!!" for w in words])


def brute(docs, told, neighbours):
    """The same vote from one dense matrix, document by document."""
    counts = {i: Q.term_counts((t or "").encode()) for i, t in docs}
    seen = np.array([c > 0 for c in counts.values()]).sum(0)
    idf = np.log((1 + len(docs)) / (1 + seen)) + 1
    train = sorted(i for i in told if zlib.crc32(str(i).encode()) % 3 != 1 and i in counts)
    x = Q.weighted(np.array([counts[i] for i in train], np.float32), idf)
    space = np.linalg.svd(x.astype(np.float64), full_matrices=False)[2][:Q.RANK].T
    unit = lambda z: z / max(np.linalg.norm(z), 1e-12)
    vectors = [unit(v @ space) for v in x.astype(np.float64)]
    out = {}
    for i, c in counts.items():
        z = Q.weighted(c[None], idf)[0] @ space
        if np.linalg.norm(z) < 1e-6:
            out[i] = np.mean([told[j] for j in train])
            continue
        near = sorted(((float(unit(z) @ v), told[j]) for j, v in zip(train, vectors)), reverse=True)[:neighbours]
        w = [max(s, 0) ** Q.SHARPNESS for s, _ in near]
        out[i] = sum(a * y for a, (_, y) in zip(w, near)) / sum(w)
    return out


def test_equals_brute_force(spark):
    rows = [(i, y, t) for i, y, t in texts(random.Random(4), 150)] + [(900, 1, ""), (901, 0, None)]
    docs = spark.createDataFrame([(i, t, "x") for i, _, t in rows], "doc_id long, text string, score string").repartition(5)
    told = {i: y for i, y, _ in rows if i % 5}
    labels = spark.createDataFrame([(i, y) for i, y in told.items()] + [(5, None), (None, 1), (12345, 0)], "doc_id long, quality int")
    got = {r["doc_id"]: r["score"] for r in Q.classify(docs, labels, neighbours=7).collect()}
    want = brute([(i, t) for i, _, t in rows], told, 7)
    assert set(got) == set(want)
    assert max(abs(got[i] - want[i]) for i in want) < 0.02


def test_unlabelled_empty_and_repeated(spark):
    docs = spark.createDataFrame([(1, "some words here"), (1, "some words here"), (None, "some words here"), (2, "")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = Q.classify(docs, none).collect()
    assert len(got) == 4 and {r["score"] for r in got} == {0.5} and not next(r for r in got if r["doc_id"] is None)["held_out"]
    assert Q.classify(docs.limit(0), none).count() == 0
    twice = spark.createDataFrame([(2, 1), (2, 0), (1, 1)], "doc_id long, quality int")
    assert {r["predicted"] for r in Q.classify(docs, twice).collect()} <= {0, 1}


@pytest.mark.parametrize("raw", [b"", b"a", b"ab", b"abc", bytes(range(256)) * 3000])
def test_term_counts_add_up_over_blocks(raw):
    counts = Q.term_counts(raw)
    assert counts[:Q.TRIGRAMS].sum() == counts[Q.TRIGRAMS:Q.TRIGRAMS + Q.CLASSES].sum() == max(0, len(raw) - 2)


def test_latent_space_spans_the_leading_directions():
    rng = np.random.default_rng(1)
    x = (rng.standard_normal((80, 5)) @ rng.standard_normal((5, 200)) * 10 + rng.standard_normal((80, 200)) * 0.01).astype(np.float32)
    space = Q.latent_space(x, 5)
    exact = np.linalg.svd(x, full_matrices=False)[2][:5].T
    assert np.linalg.norm(exact - space @ (space.T @ exact)) < 1e-2
