"""The corpus pipeline: language, near duplicates, benchmark passages, tokens.

``STAGES`` lists (name, function) in order.  A function takes (spark, docs,
sf_dir) and returns a DataFrame; each stage's rows are written as Parquet and
read again as the next one's ``docs``.  All but the last return the columns of
``documents``.

1. language: rows whose language cannot be told go; ``lang`` is the one found.
2. near_dedup: of each group of near duplicates the smallest id stays.
3. decontaminate: benchmark passages are cut out of the texts; ``n_chars`` follows.
4. tokens: each text as token ids, packed as a token shard holds them.

Defined results: nulls in any column, empty and very long texts, repeated rows
and empty tables pass as each operator's docstring says: a null or letterless
text goes in stage 1; of rows with one id one stays in stage 2; other columns,
whatever their names, are carried to the last stage, which returns the id, the
language, the source and the tokens only.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm import bpe, decontaminate, language, near_dedup
from tabflow.llm.common import stored, table
from tabflow.session import ship_package


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return near_dedup.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    cleaned = decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    vocab = bpe.load_vocab(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(docs, vocab, public_tokenizers.PATTERN, carry=("lang", "source"))
    return encoded.withColumn("n_tokens", F.expr("octet_length(token_ids) div 4").cast("bigint"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", remove_benchmark),
    ("tokens", tokenize),
]

# language models and signatures are beyond SQL; tests/llm/test_pipeline.py holds the rows against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
