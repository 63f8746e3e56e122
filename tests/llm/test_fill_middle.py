import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabflow.llm import fill_middle as M

UNITS = {"line": re.compile(r"[^\n]*\n|[^\n]+"), "char": re.compile(r"(?s).")}


def brute(key, text, unit="line", rate=100, spm_rate=50):
    text = text or ""
    units = UNITS[unit].findall(text)
    h = hashlib.sha256(f"7:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h4 % 100 < spm_rate
    return n, "spm" if spm else "psm", len(p), len(m), (f"<S>{s}<P>{p}" if spm else f"<P>{p}<S>{s}") + f"<M>{m}"


def corpus():
    rng = random.Random(5)
    shared = "".join(rng.choice("äb c€\n\N{GRINNING FACE}d") for _ in range(9000))
    texts = [None, "", "\n", "\n\n\n", "no end", "end\n", "a" * 50_000, "\n" * 9_000, "<P>", "x<" + "S>", "y" * 127 + "<M>" + "z" * 500, "<P <S <M", "<", "a<", "<P" + "\n" * 3,
             "ü" * 3000 + "\n" + "ü" * 3000, shared, shared]
    for _ in range(60):
        k = rng.randrange(8000)
        texts.append("".join(rng.choice("ab\n <>PSMß") for _ in range(rng.randrange(400))) + shared[k:k + rng.randrange(4000)])
    # a sentinel at every place around a chunk's end
    for at in range(120, 140):
        texts.append("q" * at + "<S>" + "q" * 400)
    return list(enumerate(texts))


@pytest.mark.parametrize("unit,rate,spm_rate", [("line", 100, 50), ("char", 60, 20)])
def test_equals_brute_force(spark, unit, rate, spm_rate):
    rows = corpus() + [(None, "null id\nx\n"), (3, "the same id\nagain\n")]
    df = spark.createDataFrame([(i, t, "kept") for i, t in rows], "id long, body string, form string").repartition(4)
    out = M.transform(df, "id", "body", rate=rate, spm_rate=spm_rate, unit=unit)
    got = out.withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
    want = sorted([(str(i), *map(str, brute(i, t, unit, rate, spm_rate)), t or "") for i, t in rows])
    assert sorted((str(r["id"]), *map(str, (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"])), r["back"]) for r in got) == want


def test_carried_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a\nb\n", "x", 2.5)], "doc_id long, text string, output string, n double")
    r = M.transform(df, carry=("output", "n")).collect()[0]
    assert r[0] == 1 and r[-2:] == ("x", 2.5)
    assert M.transform(df.limit(0)).count() == 0


def test_equal_passages_share_chunks():
    rng = random.Random(9)
    passage = bytes(rng.randrange(97, 123) for _ in range(40_000))
    chunks = M.Chunks("line", ("<P>", "<S>", "<M>"))
    for n in range(5):
        raw = bytes(rng.randrange(97, 123) for _ in range(300 * n)) + passage
        text = M.Text(raw, chunks)
        assert text.points[-1] == len(raw)
    assert chunks.found / chunks.asked > 0.7
    ends = M.chunk_ends(np.frombuffer(passage, np.uint8))
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(passage) and sizes.max() <= M.MOST and sizes[:-1].min() >= M.LEAST


def test_full_cache_starts_anew():
    rng = random.Random(2)
    small = M.Chunks("line", ("<P>", "<S>", "<M>"), limit=3000)
    for n in range(30):
        text = "".join(rng.choice("ab\n") for _ in range(2000))
        t = M.Text(text.encode(), small)
        lines = UNITS["line"].findall(text)
        assert t.n == len(lines) and small.size <= 3000 + M.MOST * 3
        for k in (0, 1, len(lines) // 2, len(lines)):
            assert t.cut(k) == (len("".join(lines[:k])),) * 2
