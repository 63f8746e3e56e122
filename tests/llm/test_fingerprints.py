import hashlib

import numpy as np
import pytest

from tabflow.llm import fingerprints as P
from tabflow.llm.near_dedup import least_matches
from tabflow.llm.queries import op6_fingerprints
from tests.llm.test_near_dedup import brute, corpus, shingles

SF = "/root/testdata/sf0.001"


def test_query_follows_the_edit(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(texts)
    got = {r["doc_id"]: r for r in op6_fingerprints(spark, SF).collect()}
    assert sorted(got) == ids
    by_text = {}
    errors = []
    for n, i in enumerate(ids):
        following = texts[ids[(n + 1) % len(ids)]]
        changed = P.edited(texts[i], following)
        half = len(texts[i]) // 2
        assert changed == texts[i][:len(texts[i]) - half] + following[:half]
        r = got[i]
        assert r["n_chars"] == len(texts[i]) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert by_text.setdefault(texts[i], r["fingerprint"]) == r["fingerprint"]
        for near, other in ((r["near_edited"], changed), (r["near_next"], following)):
            a, b = shingles(texts[i]), shingles(other)
            errors.append(near - (len(a & b) / len(a | b) if a | b else 1.0))
    assert np.abs(errors).max() < 0.3 and abs(np.mean(errors)) < 0.02


@pytest.mark.parametrize("bucket", [1 << 25, 2000])
def test_next_in_order_with_nulls_and_ties(spark, bucket):
    rows = [(i, f"text {i} " * (i % 50)) for i in range(200)] + [(None, "null id"), (7, "second seven"), (7, "second seven"), (300, None), (301, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)

    def tell(texts, nexts):
        import pyarrow as pa
        return [pa.array([t.decode() for t in texts]), pa.array([t.decode() for t in nexts])]

    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["own"], r["following"]) for r in
                 P.with_next(df, tell, "own string, following string", bucket_bytes=bucket).collect())
    order = sorted((i is not None, i or 0, t or "") for i, t in rows)
    want = sorted((*o, order[(n + 1) % len(order)][2]) for n, o in enumerate(order))
    assert got == want
    assert P.edit_report(df.limit(0)).count() == 0
    one = P.edit_report(spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0


def test_empty_texts():
    zero, other = np.zeros(4, np.uint32), np.array([1, 2, 3, 4], np.uint32)
    assert (P.likeness(zero, zero), P.likeness(zero, other), P.likeness(other, other)) == (1.0, 0.0, 1.0)


def test_band_join_equals_brute_force(spark):
    rows = corpus(9)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    got = {r["doc_id"]: r for r in P.similar(df).collect()}
    assert {i: r["class_id"] for i, r in got.items()} == want
    assert all((r["n_links"] == 0) or any(want[j] == want[i] and j != i for j in want) for i, r in got.items())
    assert least_matches(64) < 48
