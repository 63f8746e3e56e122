import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tabflow.llm import bpe
from tabflow.llm.queries import op2_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocab():
    return bpe.load_vocab(PATH)


@pytest.fixture(scope="module")
def reference(vocab):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocab.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(3)
    alphabet = [*range(32, 127), *range(0, 0x200), 0x4E2D, 0x1F600, 9, 10, 13, 32, 32, 0x1C, 0x85, 0xA0, 0x2028, 0x3000]
    mixed = ["".join(chr(rng.choice(alphabet)) for _ in range(300)) for _ in range(300)]
    return mixed + ["a" * 5000, " " * 3000, "ab" * 3000, "\n" * 500, "=" * 2000, "", "<|endoftext|>", "".join(
        rng.choice("aehinorst") for _ in range(20_000))]


def test_codec_equals_library(vocab, reference):
    codec = bpe.Codec(bpe.read_ranks(vocab), public_tokenizers.PATTERN)
    for text in odd_texts():
        packed = codec.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == reference.encode_ordinary(text)
        assert codec.decode(packed) == text.encode()


def test_merges_equal_rank_order():
    """A small vocabulary against plain merging by rank."""
    tokens = [bytes([i]) for i in range(256)] + [b"ab", b"bc", b"abc", b"aa", b"aaa", b"ba", b"bab", b"cab", b"abab"]
    rank = {t: i for i, t in enumerate(tokens)}
    codec = bpe.Codec(tokens, r"[\s\S]+")
    made = {t: tokens[a] + tokens[b] for t, (a, b) in zip(tokens, codec.halves) if len(t) > 1}

    def merge(raw):
        parts = [raw[i:i + 1] for i in range(len(raw))]
        while True:
            pairs = [(rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in rank]
            if not pairs:
                return [rank[p] for p in parts]
            _, i = min(pairs)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    reachable = [t for t in tokens if merge(t) == [rank[t]]]
    assert set(made) <= set(reachable) | {t for t in tokens if len(t) > 1}
    rng = random.Random(1)
    for _ in range(2000):
        raw = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 30)))
        assert codec.encode_piece(raw) == merge(raw) or raw in rank


def test_query_equals_library(spark, reference):
    rows = {r["doc_id"]: r for r in op2_bpe(spark, SF).collect()}
    texts = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(texts)
    for t in texts:
        ids = reference.encode_ordinary(t["text"] or "")
        r = rows[t["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((t["text"] or "").encode()).hexdigest()


def test_edge_rows(spark, vocab, reference):
    df = spark.createDataFrame([(1, None, "x", 1), (None, "null id", "x", 2), (2, "", None, 3), (3, "same", "y", 4), (3, "same", "y", 4),
                                (4, "long " * 50_000, None, 5)], "doc_id long, text string, token_ids string, c0 int")
    out = bpe.encode(df, vocab, public_tokenizers.PATTERN)
    back = bpe.token_ids(bpe.decode(out, vocab, public_tokenizers.PATTERN)).collect()
    got = sorted((r["doc_id"] is None, r["doc_id"], r["ids"], bytes(r["decoded"]).decode()) for r in back)
    want = sorted((r["doc_id"] is None, r["doc_id"], reference.encode_ordinary(r["text"] or ""), r["text"] or "") for r in df.collect())
    assert got == want
    assert bpe.encode(df.limit(0), vocab, public_tokenizers.PATTERN, carry=("token_ids",)).columns == ["doc_id", "token_ids", "token_ids"]
    assert bpe.encode(df.limit(0), vocab, public_tokenizers.PATTERN).count() == 0
