import numpy as np
from pyspark.sql import functions as F

from tabflow.llm import language as L

SF = "/root/testdata/sf0.01"


def test_letters_and_trigrams():
    assert L.letters("Ab1c, É!") == b" ab c " + "é".encode() + b" "
    assert L.letters(None) == L.letters("123 ...") == b""
    a = L.trigrams(b" abc ")
    assert len(a) == 3 and a.min() >= 0 and a.max() < L.BUCKETS
    assert (L.trigrams(b"xx abc yy")[3:5] == L.trigrams(b"abc ")).all()


def test_text_alone_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.fit(docs.where("doc_id % 2 = 0"), "doc_id", "text", "lang", per_language=100)
    held = docs.where("doc_id % 2 = 1").withColumn("other", F.col("lang"))
    got = L.identify(held, label_col=None, declared_col=None, host_col=None, model=model).join(held.select("doc_id", "lang"), "doc_id")
    assert got.where("language = lang").count() / got.count() > 0.98


def test_clean_rows_are_kept_and_other_scripts_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(-1, "Это совсем другой язык " * 20, None, "src0", 1), (-2, "12345 67890 ...", "en", "src0", 1), (-3, None, "en", "src1", 1),
                                 (-4, "", None, None, None), (-5, "これは日本語の文章です。" * 30, None, None, 1)],
                                "doc_id long, text string, lang string, source string, n_chars long")
    rows = docs.unionByName(odd)
    got = {r["doc_id"]: r for r in L.identify(rows).collect()}
    assert all(r["keep"] for i, r in got.items() if i >= 0)
    assert not any(got[i]["keep"] for i in (-1, -2, -3, -4, -5))
    assert got[-3]["language"] == L.UND and got[-3]["posterior"] == 0
    same = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert np.mean([got[i]["language"] == same[i] for i in same]) > 0.99


def test_evidence_decides_unclear_texts(spark):
    """Texts that two languages explain alike: declared language, host and suffix settle them."""
    rows = [(i, "alpha beta gamma " * 5, "aa", f"h{i % 3}.aa") for i in range(400)] + \
           [(1000 + i, "alpha beta gamma delta " * 5, "bb", f"h{i % 3}.bb") for i in range(400)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = L.fit(train, "doc_id", "text", "lang")
    new = spark.createDataFrame([(*r[:2], None if r[0] % 7 == 0 else r[2], r[3]) for r in rows] + [(9000, "alpha beta", None, "new.aa"), (9001, "alpha beta", None, "new.bb"),
                                (9002, "alpha beta", "bb-BB", None)], "doc_id long, text string, told string, source string")
    got = {r["doc_id"]: r["language"] for r in L.identify(new, label_col=None, declared_col="told", host_col="source", model=model).collect()}
    assert (got[9000], got[9001], got[9002]) == ("aa", "bb", "bb")


def test_host_priors_are_smoothed_towards_suffix_and_all(spark):
    rows = [(i, "un deux trois quatre " * 4, "fr", "big.fr") for i in range(50)] + [(100 + i, "one two three four " * 4, "en", "big.com") for i in range(50)] + \
           [(200, "one two three four " * 4, "en", "small.fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    judge = L.Judge(df, "doc_id", "text", "lang", "lang", "source")
    prior = {r["p_host"]: np.exp(r["prior"]) for r in judge.priors.collect()}
    fr, en = judge.model.languages.index("fr"), judge.model.languages.index("en")
    assert all(abs(p.sum() - 1) < 1e-9 for p in prior.values())
    assert prior["big.fr"][fr] > prior["small.fr"][fr] > prior["big.com"][fr]
    total = np.array(judge.overall)
    suffix = (np.eye(3)[fr] * 50 + np.eye(3)[en] + L.SUFFIX_PSEUDO * total) / (51 + L.SUFFIX_PSEUDO)
    want = (np.eye(3)[en] + L.HOST_PSEUDO * suffix) / (1 + L.HOST_PSEUDO)
    assert np.allclose(prior["small.fr"], want)


def test_shuffled_priors_equal_broadcast(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    small = sorted(map(tuple, L.identify(docs).collect()))
    monkeypatch.setattr(L, "BROADCAST_HOSTS", 0)
    assert sorted((a, b, round(c, 9), d) for a, b, c, d in map(tuple, L.identify(docs).collect())) == [(a, b, round(c, 9), d) for a, b, c, d in small]


def test_pages_and_rows(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = L.page_evidence(pages)
    assert got.where("declared is null or host is null").count() == 0
    assert {r[0] for r in got.select("declared").distinct().collect()} == {"en", "de", "fr", "es"}
    found = L.identify(got, "page_id", "html", "declared", "declared", "host")
    assert found.count() == pages.count()
    df = spark.createDataFrame([(1, "ein kleiner Text mit Worten " * 9, "de", "s", 1, "x"), (1, "ein kleiner Text mit Worten " * 9, "de", "s", 1, "x"),
                                (None, None, None, None, None, None)], "doc_id long, text string, lang string, source string, prior int, ll string")
    kept = L.keep_identified(df)
    assert kept.columns == df.columns and sorted(map(tuple, kept.collect())) == sorted(map(tuple, df.where("text is not null").collect()))
    assert L.keep_identified(df.limit(0)).count() == 0 and L.identify(df.limit(0)).count() == 0
    assert not L.identify(df.withColumn("lang", F.lit(None).cast("string"))).first()["keep"]
