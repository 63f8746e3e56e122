"""MinHash document fingerprints (operator 6).

A text is the set of its distinct five-word shingles; its fingerprint holds the
minimum of each of ``COORDINATES`` universal hash functions over the set, taken in
vectorised numpy, written as hexadecimal digits.  The likeness of two fingerprints
is their share of equal values, which estimates the Jaccard coefficient.

``similar`` joins documents whose signatures agree in a whole band of
``BAND_ROWS`` values and verifies each pair met by the Jaccard coefficient of the
full sets; equal sets are joined beforehand and lists are met anchor by anchor
(:mod:`links`), so no group is expanded into all its pairs.

``with_next`` gives every row the text after it in the order of ids (after the
last one the first) with a single shuffle: rows go to buckets of consecutive ids
cut by literal bounds, and the first row of a bucket is also sent to the bucket
before it.  Memory is bounded by one Arrow batch and one text.

Defined results: null and empty texts, and texts without words, have the
fingerprint of zeros; two such are alike (1), one such and any other text are not
(0); null ids come first in the order; rows of equal ids follow in the order of their
texts; a table of one row is its own next; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import stored
from tabflow.llm.links import linked
from tabflow.llm.near_dedup import SHARE, confirm, shingle_sets, signatures
from tabflow.llm.shingles import WORDS, Permutations, shingle_set

COORDINATES = 64
BAND_ROWS = 3
BUCKET_BYTES = 32 << 20
MAX_BUCKETS = 4_000           # more bytes a bucket beyond; a bucket is sorted by Spark, which spills
FINE = 8                      # cuts tried per bucket
SPREAD = 4                    # partitions per bucket, so that few hashed buckets fall into one task
SLICE_ROWS = 64


def signature(raw: bytes | None, permutations: Permutations, words: int = WORDS) -> np.ndarray:
    shingles = shingle_set(raw, words)
    return permutations.signature(shingles) if len(shingles) else np.zeros(permutations.k, np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal values; the empty fingerprint is like itself only."""
    if not a.any() or not b.any():
        return float(not a.any() and not b.any())
    return float(np.mean(a == b))


def as_hex(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", coordinates: int = COORDINATES,
                 words: int = WORDS) -> DataFrame:
    """(id, n_shingles, set_key, sig) for every row; key and signature null without words."""
    return signatures(docs, id_col, text_col, coordinates, words)


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: tuple[int, int] = SHARE,
            coordinates: int = COORDINATES, band_rows: int = BAND_ROWS, words: int = WORDS) -> DataFrame:
    """(id, class_id, n_links): class of documents linked by verified likeness (its smallest id) and how
    many direct links between different texts the row's text has (those tested on the way to the class)."""
    signed = stored(fingerprints(docs, id_col, text_col, coordinates, words), "fingerprints")
    full = signed.where("id is not null and n > 0")
    classes = stored(full.groupBy("set_key").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig")), "classes")
    members = full.select("id", "set_key").distinct().join(classes.select("set_key", F.col("id").alias("rep")), "set_key").select("id", "rep").distinct()
    members = stored(members, "members")
    n_bands = coordinates // band_rows
    bands = F.array(*[F.xxhash64(F.lit(i), F.slice("sig", i * band_rows + 1, band_rows)) for i in range(n_bands)])
    posted = classes.select("id", "n", F.explode(bands).alias("key"))
    shared = posted.groupBy("key").agg(F.count(F.lit(1)).alias("docs")).where("docs > 1")
    postings = stored(posted.join(shared.select("key"), "key").select("key", "id", "n", F.col("n").alias("rest")), "postings")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sets = stored(shingle_sets(texts.join(postings.select("id").distinct(), "id", "left_semi"), words), "sets")
    several = members.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("a", "b")
    links, labels = linked(postings, lambda pairs, n: confirm(pairs, n, sets, share), several, share)
    ends = links.select(F.col("a").alias("rep")).unionAll(links.select(F.col("b").alias("rep"))).groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
    found = (members.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left").join(ends, "rep", "left")
             .groupBy("id").agg(F.min(F.coalesce("component", "rep")).alias("class_id"), F.max(F.coalesce("links", F.lit(0).cast("bigint"))).alias("n_links")))
    out = signed.select("id").join(found, "id", "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"))


def with_next(docs: DataFrame, function, schema: str, id_col: str = "doc_id", text_col: str = "text",
              bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Apply ``function(texts, next_texts) -> columns`` in the order of ids; ``schema`` names its columns.

    ``function`` gets two lists of UTF-8 bytes (null: empty) and returns a list of Arrow arrays.
    """
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(-2 ** 63)).alias("at"), raw.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    # literal bounds of buckets of about bucket_bytes: fine cuts by number of rows, joined by their bytes
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    bucket_bytes = max(bucket_bytes, -(-total // MAX_BUCKETS))
    wanted = (total // bucket_bytes + 1) * FINE
    cuts: list[int] = []
    if wanted > FINE:
        steps = [i / wanted for i in range(1, wanted)]
        fine = sorted(set(rows.agg(F.percentile_approx("at", steps, max(10_000, 10 * wanted))).first()[0] or []))
        sizes = {r["b"]: r["s"] for r in rows.groupBy(_bucket(F.col("at"), fine).alias("b")).agg(
            F.sum(F.octet_length("text")).alias("s")).collect()}       # at most FINE rows a bucket
        held = 0
        for i, cut in enumerate(fine):
            held += sizes.get(i, 0)
            if held + sizes.get(i + 1, 0) > bucket_bytes:
                cuts.append(cut)
                held = 0
    bucket = _bucket(F.col("at"), cuts)
    firsts = sorted((r["b"], r["first"]) for r in rows.groupBy(bucket.alias("b")).agg(F.min("at").alias("first")).collect())  # a row a bucket
    sent = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}   # to the bucket before; the very first to the last
    ahead = docs.sparkSession.createDataFrame([(int(f), int(b)) for f, b in sent.items()], "at long, ahead long")
    own = rows.select("id", "at", "text", bucket.alias("bucket"), F.lit(0).alias("ghost"))
    ghost = rows.join(F.broadcast(ahead), "at").select("id", "at", "text", F.col("ahead").alias("bucket"), F.lit(1).alias("ghost"))
    dealt = own.unionByName(ghost).repartition(max(1, SPREAD * len(firsts)), "bucket").sortWithinPartitions("bucket", "ghost", "at", "text")

    def run(batches):
        held = None            # (bucket, id, text) of the last own row, waiting for its next text
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                ids, texts, nexts = [], [], []
                for i, text, b, is_ghost in zip(part.column("id").to_pylist(), part.column("text").to_pylist(),
                                                part.column("bucket").to_pylist(), part.column("ghost").to_pylist()):
                    if held is not None and held[0] == b:
                        ids.append(held[1])
                        texts.append(held[2])
                        nexts.append(text)
                        held = None
                    if not is_ghost:
                        held = (b, i, text)
                if ids:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, part.column("id").type), *function(texts, nexts)], names)

    names = ["id", *[c.split()[0] for c in schema.split(",")]]
    out = dealt.mapInArrow(run, f"id {kind}, {schema}")
    return out.withColumnRenamed("id", id_col)


def _bucket(value: Column, cuts: list[int]) -> Column:
    """How many cuts lie at or below the value."""
    if not cuts:
        return F.lit(0).cast("bigint")
    edges = np.array(cuts)

    @F.pandas_udf("long")
    def number(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, at.to_numpy(), side="right"))

    return number(value)


def edited(text: str, following: str) -> str:
    """The text with its last floor(n / 2) code points replaced by the first as many (or all) of the next."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", coordinates: int = COORDINATES,
                words: int = WORDS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next): how fingerprints
    follow an edit of half a text and an unrelated text."""
    def compare(texts, nexts):
        permutations = Permutations(coordinates)
        n, new, own_hex, new_hex, near_new, near_next = [], [], [], [], [], []
        following, after = None, None
        for raw, ahead in zip(texts, nexts):
            text = raw.decode("utf-8")
            changed = edited(text, ahead.decode("utf-8")).encode("utf-8")
            # the text that followed the last one is mostly this one
            own = following if after == raw and following is not None else signature(raw, permutations, words)
            other, following, after = signature(changed, permutations, words), signature(ahead, permutations, words), ahead
            n.append(len(text))
            new.append(changed)
            own_hex.append(as_hex(own))
            new_hex.append(as_hex(other))
            near_new.append(likeness(own, other))
            near_next.append(likeness(own, following))
        return [pa.array(n, pa.int64()), pa.array(new, pa.binary()), pa.array(own_hex), pa.array(new_hex),
                pa.array(near_new, pa.float64()), pa.array(near_next, pa.float64())]

    return with_next(docs, compare, "n_chars bigint, edited binary, fingerprint string, edited_fingerprint string, "
                     "near_edited double, near_next double", id_col, text_col, bucket_bytes)
