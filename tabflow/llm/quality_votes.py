"""Quality classifier by nearest-neighbour voting over latent-semantic vectors (operator 12).

Terms are hashed byte trigrams and trigrams of byte classes (capital, small letter, digit, each other byte for itself), as
log(1 + count) times the inverse document frequency, and the numbers of words that are fresh, repeat the word before, or stand in
a line or a run met before; each of the three parts has length one.  Document frequencies are counted over all documents (``TERMS`` numbers,
summed in Spark).  The latent space comes from a bounded sample of labelled rows, at most ``PER_LABEL`` of each label, those of
smallest hash: the leading right singular vectors of their term matrix, by randomized subspace iteration.

The labelled vectors (``2 * PER_LABEL * RANK`` floats at most) and the projection (``TERMS * RANK``) are broadcast; their size is
fixed by these parameters, whatever the corpus.  Every document is projected and its cosines with all labelled vectors
are computed in blocks, exactly; the ``NEIGHBOURS`` nearest vote with their label, weighted by similarity and by the share
that the label has among all labelled rows over its share of the sample.  The score is the weighted mean of the votes.

A score is a function of the text alone: equal texts have equal scores up to the last bits of a float.  Nothing is
shuffled but term counts and the sample.

Defined results: null and empty texts, and texts of which no term was seen in the sample, have the share of label 1 among the
labelled rows (0.5 without any); rows labelled several times count with the mean of their labels; null labels and labels of unknown ids
are left out; a null id is never held out; documents of one id are scored each; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRIGRAMS, CLASSES, REPEATS = 4096, 1024, 4
TERMS = TRIGRAMS + CLASSES + REPEATS
RANK = 64
PER_LABEL = 1500
NEIGHBOURS = 25
SHARPNESS = 4
BLOCK_ROWS = 256
BLOCK_BYTES = 1 << 18
SEED = 12
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
# byte classes: capitals, small letters, digits, bytes of longer characters; every other byte is its own class
_CLASS = np.arange(256, dtype=np.uint64)
_CLASS[0x41:0x5B], _CLASS[0x61:0x7B], _CLASS[0x30:0x3A], _CLASS[0x80:] = 0x41, 0x61, 0x30, 0x80


def _bucket(x: np.ndarray, bits: int) -> np.ndarray:
    return ((x * _MULTIPLY) >> np.uint64(64 - bits)).astype(np.int64)


def _trigrams(b: np.ndarray) -> np.ndarray:
    return (b[:-2] << np.uint64(16)) | (b[1:-1] << np.uint64(8)) | b[2:]


def _repeats(raw: bytes) -> tuple[int, int, int, int]:
    """Words that are fresh, that equal the word before, that stand in a line or in a run of eight words met before."""
    words = raw.split()
    same = sum(map(bytes.__eq__, words, words[1:]))
    lines = [line.split() for line in raw.split(b"\n")]
    again = [sum(len(u) for u in _met_before(units)) for units in (lines, [words[i:i + 8] for i in range(0, len(words), 8)])]
    return (max(0, len(words) - max(same, *again)), same, *again)


def _met_before(units: list[list[bytes]]):
    met: set = set()
    for unit in map(tuple, units):
        if unit in met:
            yield unit
        met.add(unit)


def term_counts(raw: bytes) -> np.ndarray:
    """How often each of the ``TERMS`` terms occurs in a text."""
    out = np.zeros(TERMS)
    for at in range(0, max(0, len(raw) - 2), BLOCK_BYTES):
        b = np.frombuffer(raw, np.uint8)[at:at + BLOCK_BYTES + 2]
        wide = b.astype(np.uint64)
        out[:TRIGRAMS] += np.bincount(_bucket(_trigrams(wide), 12), minlength=TRIGRAMS)
        out[TRIGRAMS:TRIGRAMS + CLASSES] += np.bincount(_bucket(_trigrams(_CLASS[b]), 10), minlength=CLASSES)
    out[TRIGRAMS + CLASSES:] = _repeats(raw)
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of three parts of length one each (or zero): log counts times idf of both kinds of trigrams, and repeats."""
    x = np.log1p(counts) * idf
    x[..., TRIGRAMS + CLASSES:] = counts[..., TRIGRAMS + CLASSES:]
    for part in np.split(x, (TRIGRAMS, TRIGRAMS + CLASSES), axis=-1):
        size = np.linalg.norm(part, axis=-1, keepdims=True)
        part /= np.where(size > 0, size, 1)
    return x.astype(np.float32)


def latent_space(x: np.ndarray, rank: int = RANK, rounds: int = 4) -> np.ndarray:
    """(terms, rank): the leading right singular vectors of ``x``."""
    rank = min(rank, *x.shape)
    if rank == 0:
        return np.zeros((x.shape[1], 0), np.float32)
    rng = np.random.default_rng(SEED)
    basis = x.T @ (x @ rng.standard_normal((x.shape[1], min(rank + 16, x.shape[1]))).astype(np.float32))
    for _ in range(rounds):
        basis = x.T @ (x @ np.linalg.qr(basis)[0])
    basis = np.linalg.qr(basis)[0]
    _, _, turned = np.linalg.svd(x @ basis, full_matrices=False)
    return np.ascontiguousarray((basis @ turned.T)[:, :rank], np.float32)


@dataclass
class Model:
    """What is broadcast: idf, projection, labelled vectors with their votes and weights, and the share of label 1."""
    idf: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    votes: np.ndarray
    weights: np.ndarray
    share: float
    neighbours: int = NEIGHBOURS

    def project(self, counts: np.ndarray) -> np.ndarray:
        z = weighted(counts, self.idf) @ self.space
        size = np.linalg.norm(z, axis=1, keepdims=True)
        return np.where(size > 1e-6, z / np.where(size > 1e-6, size, 1), 0).astype(np.float32)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Votes of the nearest labelled vectors for a block of documents."""
        if not len(self.vectors):
            return np.full(len(counts), self.share)
        z = self.project(counts)
        near = z @ self.vectors.T
        k = min(self.neighbours, near.shape[1])
        at = np.argpartition(-near, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(near, at, 1).astype(np.float64), 0) ** SHARPNESS * self.weights[at]
        total = w.sum(1)
        mean = (w * self.votes[at]).sum(1) / np.where(total > 0, total, 1)
        return np.where((total > 0) & z.any(1), np.clip(mean, 0, 1), self.share)


def held_out(id_column):
    """Whether an id is kept from training: crc32 of its text leaves 1 by 3."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[int, np.ndarray]:
    """(documents, in how many of them each term occurs), over all of them; ``TERMS`` numbers reach the driver."""
    def run(batches):
        n, found = 0, np.zeros(TERMS, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                n += 1
                found += term_counts(raw) > 0
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, TERMS), pa.int32()), pa.array(np.concatenate(([n], found)))], ["term", "n"])

    parts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")).mapInArrow(run, "term int, n long")
    rows = {r["term"]: r["n"] for r in parts.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return rows.get(-1, 0), np.array([rows.get(t, 0) for t in range(TERMS)], np.int64)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, per_label: int):
    """Term counts and labels of the sample, with (rows labelled 0, rows labelled 1) outside the held-out part."""
    told = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
            .groupBy(F.col(id_col).alias("id")).agg(F.avg(F.col(label_col).cast("double")).alias("vote")))
    known = told.join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
    counts = known.agg(F.count_if(F.col("vote") < 0.5).alias("low"), F.count_if(F.col("vote") >= 0.5).alias("high")).first()
    order = (F.xxhash64("id", F.lit(SEED)), F.col("id"))
    picked = known.where("vote < 0.5").orderBy(*order).limit(per_label).unionByName(known.where("vote >= 0.5").orderBy(*order).limit(per_label))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    # 2 * per_label ids and labels
    rows = texts.join(F.broadcast(picked), "id")

    def run(batches):
        for batch in batches:
            counted = [term_counts(raw).astype(np.float32).tobytes() for raw in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vote"), pa.array(counted, pa.binary())], ["id", "vote", "counts"])

    kind = rows.schema["id"].dataType.simpleString()
    # of rows that share an id one stands for the sample
    found = (rows.select("id", "vote", "text").mapInArrow(run, f"id {kind}, vote double, counts binary")
             .groupBy("id").agg(F.min_by(F.struct("vote", "counts"), F.xxhash64("counts")).alias("x")).select("id", "x.*").collect())
    found.sort(key=lambda r: r["id"])
    x = np.array([np.frombuffer(r["counts"], np.float32) for r in found], np.float32).reshape(-1, TERMS)
    return x, np.array([r["vote"] for r in found], np.float64), (counts["low"], counts["high"])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        rank: int = RANK, per_label: int = PER_LABEL, neighbours: int = NEIGHBOURS) -> Model:
    n, frequency = document_frequencies(docs, text_col)
    idf = np.log((1 + n) / (1 + frequency)) + 1
    counts, votes, (low, high) = labelled_sample(docs, labels, label_col, id_col, text_col, per_label)
    share = high / (low + high) if low + high else 0.5
    space = latent_space(weighted(counts, idf), rank) if len(counts) else np.zeros((TERMS, 0), np.float32)
    model = Model(idf, space, np.zeros((0, space.shape[1]), np.float32), votes, np.ones(len(votes)), share, neighbours)
    if len(counts):
        model.vectors = model.project(counts)
        part = (votes >= 0.5).mean()
        model.weights = np.where(votes >= 0.5, share / max(part, 1e-9), (1 - share) / max(1 - part, 1e-9))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                counts = np.array([term_counts(raw) for raw in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(shared.value.score(counts))], ["id", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"id {kind}, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Fit on the labelled rows that are not held out and score all documents."""
    names = {k: options[k] for k in ("id_col", "text_col") if k in options}
    return score(docs, fit(docs, labels, **options), **names)
