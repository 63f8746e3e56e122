import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from tabflow.llm import bpe
from tabflow.llm.common import stored
from tests.llm import test_decontaminate as passages
from tests.llm import test_near_dedup as copies

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stages(spark, docs):
    """The tables that each stage leaves, first the input."""
    out = [docs]
    for name, stage in C.STAGES:
        out.append(stored(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def test_rows_equal_brute_force(spark):
    tables = stages(spark, spark.read.parquet(f"{SF}/documents.parquet"))
    given, spoken, single, clean, tokens = [{r["doc_id"]: r for r in t.collect()} for t in tables]
    assert all(t.columns == COLUMNS and t.schema == tables[0].schema for t in tables[1:4])
    assert [n for n, _ in C.STAGES] == ["language", "near_dedup", "decontaminate", "tokens"] and C.ORACLE_SQL is None
    # every text of the fixture is in one of its languages
    assert spoken == given
    component = copies.brute([(i, r["text"]) for i, r in spoken.items()])
    assert set(single) == {i for i in component if component[i] == i}
    assert all(single[i] == spoken[i] for i in single)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = passages.brute([single[i]["text"] for i in single], items)
    after = passages.brute([clean[i]["text"] for i in single], items)
    assert any(b[1] for b in before) and not any(a[1] for a in after)
    for i, (n, hit, _), (m, _, _) in zip(single, before, after):
        assert clean[i]["n_chars"] == len(clean[i]["text"])
        assert m <= n - len(hit)
        if not hit:
            assert clean[i] == single[i]
    codec = bpe.Codec(bpe.read_ranks(bpe.load_vocab(public_tokenizers.path("byte_bpe_50k.tiktoken"))), public_tokenizers.PATTERN)
    assert set(tokens) == set(clean)
    for i, r in tokens.items():
        assert codec.decode(bytes(r["token_ids"])).decode() == clean[i]["text"] and r["n_tokens"] == len(r["token_ids"]) // 4
    run = {r["doc_id"]: r for r in C.run(spark, SF).collect()}
    assert run == tokens


@pytest.mark.parametrize("stage", range(4))
def test_odd_rows_and_clashing_columns(spark, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", None, None, 0), (-2, "12 34 !!", "en", "src1", 8), (-3, "the and of " * 50_000, "en", None, None),
                                 (-4, "the ing and the other thing is that", "en", "src1", 3), (-4, "the ing and the other thing is that", "en", "src1", 3),
                                 (None, "the ing and the tion", None, "src0", 1)], docs.schema)
    rows = docs.unionByName(odd).selectExpr("*", *[f"1 as {c}" for c in "id key component kept ll prior c0 d0 token_ids edges items count rep".split()])
    out = C.STAGES[stage][1](spark, rows, SF)
    got = out.collect()
    ids = [r["doc_id"] for r in got]
    if stage < 3:
        assert out.columns == rows.columns
    if stage == 0:
        assert not {-1, -2} & set(ids) and sorted(i for i in ids if i is not None and i < 0) == [-4, -4, -3] and ids.count(None) == 1
    elif stage == 1:
        assert ids.count(-4) == 1 and ids.count(None) == 2 and {-1, -2, -3} <= set(ids)
    else:
        assert sorted(map(str, ids)) == sorted(str(r["doc_id"]) for r in rows.select("doc_id").collect())
    assert C.STAGES[stage][1](spark, rows.limit(0), SF).count() == 0


def test_language_stage_corrects_the_column(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    wrong = docs.withColumn("lang", F.when(F.col("doc_id") == 8, "es").otherwise(F.col("lang")))
    was = docs.where("doc_id = 8").first()["lang"]
    got = C.identify_language(spark, wrong, SF).where("doc_id = 8").first()["lang"]
    assert got == was or was == "es"
    assert np.isclose(C.identify_language(spark, docs, SF).count(), docs.count())
