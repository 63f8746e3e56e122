"""Language identification by Bayesian evidence fusion (operator 7).

For every row the log posterior of a language adds up
  * the text: byte trigrams of the lower-cased letters under each language's
    trigram model, weighed by 1/3 as every byte is read by three trigrams;
  * the declared markup language: how often pages of that language (as judged by
    text alone) declare it, from a grouped count over all rows;
  * the address: the prior of its host, smoothed towards the prior of its address
    suffix, which is smoothed towards the prior of all rows; all three come from
    grouped counts of the text-only judgement over all rows.
Besides the trained languages there is ``und``, a uniform model of the same
trigrams that wins when no trained language explains the text.  A row is rejected when it has no
letters, when ``und`` wins, or when the best posterior is under ``min_posterior``.

The trigram models are fitted on a bounded sample of labelled rows: per label
about ``SAMPLE_PER_LANGUAGE`` rows, those of the smallest id hashes.  Counts and priors cover
all rows.  Scale: the model is at most ``MAX_LANGUAGES`` * 2^16 floats, checked and
broadcast; scoring is narrow; evidence is counted by (host, suffix, language)
with map-side sums; priors have one row per host and are broadcast only up to
``BROADCAST_HOSTS`` hosts, else joined by shuffle where a hot host can be split.

Defined results: null or letterless text is ``und`` with posterior 0 and rejected;
null evidence adds nothing; unknown declared languages add nothing; repeated rows
are judged alike; an empty table, or one without labels, rejects nothing because it
has no rows, or judges every row ``und``; other columns are carried, never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import stored

BUCKETS = 1 << 16
SAMPLE_PER_LANGUAGE = 1_000
MAX_LANGUAGES = 400
BROADCAST_HOSTS = 200_000
TEXT_WEIGHT = 1 / 3
HOST_PSEUDO, SUFFIX_PSEUDO, GLOBAL_PSEUDO = 20.0, 100.0, 1.0
MIN_POSTERIOR = 0.5
SLICE_BYTES = 1 << 20
UND = "und"

# letters of ASCII and all bytes of other scripts stay, everything else is a blank
LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def letters(text: str | None) -> bytes:
    """Lower-cased words apart by one blank, a blank at both ends; empty without letters."""
    found = (text or "").lower().encode("utf-8", "replace").translate(LETTERS).split()
    return b" " + b" ".join(found) + b" " if found else b""


def trigrams(raw: bytes) -> np.ndarray:
    """Buckets of all byte trigrams of ``raw``."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    mixed = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
    return ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x27D4EB2F) >> np.uint32(16)).astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches of about ``SLICE_BYTES`` of text with the letters of every row."""
    for batch in batches:
        start, size, held = 0, 0, []
        column = batch.column(text_col)
        for i in range(batch.num_rows):
            held.append(letters(column[i].as_py()))
            size += len(held[-1])
            if size >= SLICE_BYTES:
                yield batch.slice(start, len(held)), held
                start, size, held = i + 1, 0, []
        if held:
            yield batch.slice(start, len(held)), held


class Model:
    """Languages and their log probabilities per trigram bucket."""

    def __init__(self, languages: list[str], log_p: np.ndarray):
        self.languages, self.log_p = languages, log_p


def fit(rows: DataFrame, id_col: str, text_col: str, label_col: str, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Trigram models from a bounded sample of labelled rows."""
    labelled = rows.select(F.col(label_col).cast("string").alias("label"), F.col(text_col).cast("string").alias("text"),
                           F.xxhash64(id_col).alias("h")).where("label is not null and text is not null")
    there = labelled.groupBy("label").count().limit(MAX_LANGUAGES + 1).collect()
    if len(there) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # the id hash is uniform, so a bound on it takes the wanted share of every label without moving a text
    chosen = F.lit(False)
    for r in there:
        share = min(1.0, per_language / r["count"])
        bound = min(int(-2 ** 63 + share * 2 ** 64), 2 ** 63 - 1)
        chosen = chosen | ((F.col("label") == r["label"]) & (F.col("h") <= bound))
    sample = labelled.where(chosen).select("label", "text")

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for part, raws in _chunks(batches, "text"):
            for label, raw in zip(part.column("label").to_pylist(), raws):
                if raw:
                    total[label] = total.get(label, 0) + np.bincount(trigrams(raw), minlength=BUCKETS)
        for label, counts in total.items():
            used = np.nonzero(counts)[0]
            yield pa.RecordBatch.from_pydict({"label": pa.array([label] * len(used), pa.string()),
                                              "bucket": pa.array(used, pa.int64()), "n": pa.array(counts[used], pa.int64())})

    counted = sample.mapInArrow(count, "label string, bucket long, n long")
    tables = stored(counted.groupBy("label", "bucket").agg(F.sum("n").alias("n")), "trigrams")
    languages = sorted(r["label"] for r in there)
    counts = np.zeros((len(languages), BUCKETS), np.float64)
    # at most MAX_LANGUAGES * 2^16 rows, fetched language by language
    for i, language in enumerate(languages):
        own = tables.where(F.col("label") == language).select("bucket", "n").toArrow()
        counts[i, own.column("bucket").to_numpy()] = own.column("n").to_numpy()
    log_p = np.log((counts + 0.02) / (counts.sum(axis=1, keepdims=True) + 0.02 * BUCKETS))
    uniform = np.full((1, BUCKETS), -np.log(BUCKETS))
    return Model([*languages, UND], np.concatenate((log_p, uniform)).astype(np.float32))


def score(rows: DataFrame, model: Model, text_col: str, out: str) -> DataFrame:
    """All columns and ``out``: the weighed log likelihood of the text per language, empty without letters."""
    shared = rows.sparkSession.sparkContext.broadcast(model.log_p)
    inner = [f"c{i}" for i in range(len(rows.columns))]
    text = inner[rows.columns.index(text_col)]
    plain = rows.select(*[F.col(f"`{n}`").alias(c) for n, c in zip(rows.columns, inner)])
    schema = plain.withColumn("ll", F.array().cast("array<double>")).schema

    def run(batches):
        log_p = shared.value
        for part, raws in _chunks(batches, text):
            sizes = np.array([max(0, len(r) - 2) for r in raws])
            full = np.nonzero(sizes)[0]
            sums = np.zeros((len(raws), len(log_p)))
            if len(full):
                grams = [trigrams(raws[i]) for i in full]
                starts = np.concatenate(([0], np.cumsum([len(g) for g in grams])[:-1]))
                grams = np.concatenate(grams)
                for k, table in enumerate(log_p):
                    sums[full, k] = np.add.reduceat(table[grams], starts, dtype=np.float64)
            values = pa.array([list(s * TEXT_WEIGHT) if n else [] for s, n in zip(sums, sizes)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*part.columns, values], schema=pa.schema(
                [*part.schema, pa.field("ll", values.type)]))

    scored = plain.mapInArrow(run, schema)
    return scored.select(*[F.col(c).alias(n) for c, n in zip(inner, rows.columns)], F.col("ll").alias(out))


def _argmax(values: Column, names: Column) -> Column:
    return F.element_at(names, F.array_position(values, F.array_max(values)).cast("int"))


class Judge:
    """Everything learnt from all rows: the model, how languages are declared, and the host priors."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, label_col: str | None, declared_col: str | None,
                 host_col: str | None, per_language: int = SAMPLE_PER_LANGUAGE, model: Model | None = None):
        self.text_col, self.declared_col, self.host_col = text_col, declared_col, host_col
        self.model = model or fit(docs, id_col, text_col, label_col, per_language)
        names = self.model.languages
        declared, host, suffix = self._evidence(docs)
        narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), declared.alias("declared"),
                             host.alias("host"), suffix.alias("suffix"))
        self.scored = stored(score(narrow, self.model, "text", "ll").drop("text"), "language")
        guess = _argmax(F.col("ll"), F.array(*map(F.lit, names)))
        seen = stored(self.scored.where(F.size("ll") > 0).groupBy("host", "suffix", "declared", guess.alias("guess"))
                      .agg(F.count(F.lit(1)).alias("n")), "language")
        n_rows, langs = len(names), names
        total = {r["guess"]: r["n"] for r in seen.groupBy("guess").agg(F.sum("n").alias("n")).collect()}   # one row per language
        everything = sum(total.values())
        overall = [(total.get(x, 0) + GLOBAL_PSEUDO) / (everything + GLOBAL_PSEUDO * n_rows) for x in langs]
        # declared | language, over the trained languages only: at most MAX_LANGUAGES^2 rows
        told = {(r["guess"], r["declared"]): r["n"] for r in seen.where(F.col("declared").isin(langs)).groupBy("guess", "declared")
                .agg(F.sum("n").alias("n")).collect()}
        self.declared = {d: [float(np.log((told.get((x, d), 0) + (n_rows if x == d else 1)) / (
            sum(told.get((x, e), 0) for e in langs) + 2 * n_rows))) for x in langs] for d in langs if d != UND}
        counts = [F.sum(F.when(F.col("guess") == x, F.col("n")).otherwise(0)) for x in langs]
        by_suffix = seen.where("suffix is not null").groupBy("suffix").agg(F.array(*counts).alias("s"))
        by_host = seen.where("host is not null").groupBy("host", "suffix").agg(F.array(*counts).alias("h"))
        blend = lambda own, above, pseudo: F.transform(own, lambda n, i: (n + pseudo * F.element_at(above, i + 1)) / (
            F.aggregate(own, F.lit(0).cast("bigint"), lambda a, b: a + b) + pseudo))
        self.overall = overall
        flat = F.array(*map(F.lit, overall))
        suffixes = by_suffix.select("suffix", blend(F.col("s"), flat, SUFFIX_PSEUDO).alias("above"))
        joined = by_host.join(suffixes, "suffix", "left").withColumn("above", F.coalesce("above", flat))
        prior = blend(F.col("h"), F.col("above"), HOST_PSEUDO)
        self.priors = stored(joined.select(F.col("host").alias("p_host"), F.transform(prior, lambda p: F.log(p)).alias("prior"))
                             .dropDuplicates(["p_host"]), "language")
        self.few_hosts = self.priors.count() <= BROADCAST_HOSTS

    def _evidence(self, docs: DataFrame) -> tuple[Column, Column, Column]:
        nothing = F.lit(None).cast("string")
        declared = F.lower(F.substring_index(F.trim(F.col(self.declared_col).cast("string")), "-", 1)) if self.declared_col else nothing
        host = F.lower(F.col(self.host_col).cast("string")) if self.host_col else nothing
        # the last label of a host name; a name without a point has no suffix
        suffix = F.when(F.instr(host, ".") > 0, F.substring_index(host, ".", -1)) if self.host_col else nothing
        return declared, host, suffix

    def posterior(self, scored: DataFrame, ll: str, declared: Column, host: Column) -> DataFrame:
        """All columns and lang, posterior, keep (under the names ``j_...``)."""
        langs = self.model.languages
        names = F.array(*map(F.lit, langs))
        prior = F.broadcast(self.priors) if self.few_hosts else self.priors
        rows = scored.withColumn("j_host", host).withColumn("j_declared", declared)
        rows = rows.join(prior, F.col("j_host") == F.col("p_host"), "left")
        flat = F.array(*[F.lit(float(np.log(p))) for p in self.overall])
        said = F.lit(None).cast("array<double>")
        for d, logs in self.declared.items():
            said = F.when(F.col("j_declared") == d, F.array(*map(F.lit, logs))).otherwise(said)
        rows = rows.withColumn("j_prior", F.coalesce("prior", flat)).withColumn("j_said", said)
        logs = F.transform(F.col(ll), lambda x, i: x + F.element_at("j_prior", i + 1) + F.coalesce(
            F.element_at("j_said", i + 1), F.lit(0.0)))
        rows = rows.withColumn("j_logs", logs)
        best = F.array_max("j_logs")
        weight = F.aggregate("j_logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("j_logs")))
        some = F.size("j_logs") > 0
        rows = rows.withColumn("j_lang", F.when(some, F.element_at(names, F.array_position("j_logs", best).cast("int"))).otherwise(UND))
        rows = rows.withColumn("j_posterior", F.when(some, 1.0 / weight).otherwise(0.0))
        return rows.drop("j_host", "p_host", "prior", "j_declared", "j_prior", "j_said", "j_logs")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str | None = "lang",
             declared_col: str | None = "lang", host_col: str | None = "source", min_posterior: float = MIN_POSTERIOR,
             per_language: int = SAMPLE_PER_LANGUAGE, model: Model | None = None) -> DataFrame:
    """(id, language, posterior, keep) for every row."""
    judge = Judge(docs, id_col, text_col, label_col, declared_col, host_col, per_language, model)
    out = judge.posterior(judge.scored, "ll", F.col("declared"), F.col("host"))
    return out.select(F.col("id").alias(id_col), F.col("j_lang").alias("language"), F.col("j_posterior").alias("posterior"),
                      ((F.col("j_lang") != UND) & (F.col("j_posterior") >= min_posterior)).alias("keep"))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
                    declared_col: str | None = "lang", host_col: str | None = "source",
                    min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """The rows that are not rejected, all columns, ``label_col`` set to the language found.

    Texts are scored again as they pass by, so that no text is shuffled and every row is judged by itself.
    """
    judge = Judge(docs, id_col, text_col, label_col, declared_col, host_col)
    names = docs.columns
    inner = [f"d{i}" for i in range(len(names))]
    declared, host, _ = judge._evidence(docs)
    evidence = docs.select(*[F.col(f"`{n}`").alias(c) for n, c in zip(names, inner)], declared.alias("e_declared"), host.alias("e_host"))
    scored = score(evidence, judge.model, inner[names.index(text_col)], "e_ll")
    out = judge.posterior(scored, "e_ll", F.col("e_declared"), F.col("e_host")).where(
        (F.col("j_lang") != UND) & (F.col("j_posterior") >= min_posterior))
    return out.select(*[F.col("j_lang" if n == label_col else c).alias(n) for n, c in zip(names, inner)])


def page_evidence(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages with ``declared`` (the lang attribute of the html element) and ``host``, for :func:`identify`."""
    declared = F.regexp_extract(F.col(html_col), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    host = F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return pages.withColumns({"declared": F.when(declared != "", declared), "host": F.when(host != "", host)})
