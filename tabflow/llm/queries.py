"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tabflow.llm import bpe, decontaminate, fill_middle, fingerprints, hilbert, html_text, language, licenses, near_dedup, quality_votes, repair, reply_trees, url_rules
from tabflow.llm.common import table

SHARDS = 24


def op1_decontaminate(spark, sf_dir):
    """Hit words and items of every document against the whole benchmark."""
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


def op2_bpe(spark, sf_dir):
    """Encode every text, decode the ids, give the digests of both."""
    vocab = bpe.load_vocab(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(table(spark, sf_dir, "documents"), vocab, public_tokenizers.PATTERN)
    back = bpe.decode(encoded, vocab, public_tokenizers.PATTERN)
    return back.select("doc_id", F.expr("octet_length(token_ids) div 4").cast("bigint").alias("n_tokens"),
                       F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_near_dedup(spark, sf_dir):
    """Components of near-duplicate documents."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_html_text(spark, sf_dir):
    """The main text of every page."""
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op5_licenses(spark, sf_dir):
    """The licences that every document names."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["licence"])))
    best = F.array_max(F.transform("matches", lambda m: m["dice"]))
    return found.select("doc_id", F.size("matches").cast("bigint").alias("n_matches"), F.array_join(names, ",").alias("licences"),
                        (F.round(best * 1e6) / 1e6).alias("best_dice"))


def op6_fingerprints(spark, sf_dir):
    """Fingerprints of every text, its edited text and the next text."""
    found = fingerprints.edit_report(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
                        "near_edited", "near_next")


def op7_language(spark, sf_dir):
    """The language of every document and whether it is kept."""
    return language.identify(table(spark, sf_dir, "documents"))


def op8_url_rules(spark, sf_dir):
    """Judge every page's URL by the five rules."""
    rules = spark.createDataFrame(url_rules.RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op9_hilbert(spark, sf_dir):
    """Place every document into one of 24 shards along the curve."""
    placed = hilbert.assign(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op10_reply_trees(spark, sf_dir):
    """Format every conversation, and conversation -7, then read the output back."""
    odd = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = reply_trees.format_paths(reply_trees.as_chain(rows))
    said = F.array_join(F.transform(reply_trees.read_turns(F.col("formatted")),
                                    lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = reply_trees.read_loss(F.col("formatted"), F.col("loss"))
    return out.select(F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).cast("bigint").alias("conv_id"), "n_turns",
                      F.sha2(said, 256).alias("turns_sha256"), F.length(learned).cast("bigint").alias("loss_chars"),
                      F.sha2(learned, 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"))


def op11_fill_middle(spark, sf_dir):
    """Every text cut into prefix, middle and suffix by seed, and built again from the output."""
    out = fill_middle.transform(table(spark, sf_dir, "documents"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


def op12_quality_votes(spark, sf_dir):
    """Quality of every document by the votes of its nearest labelled neighbours."""
    return quality_votes.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_structure_repair(spark, sf_dir):
    """Damage every conversation by seed and repair its structure."""
    rows = repair.damaged(table(spark, sf_dir, "conversations"))
    return repair.repair(rows, copies_col="copies")


QUERIES = {"op1_decontaminate": op1_decontaminate, "op2_bpe": op2_bpe, "op3_near_dedup": op3_near_dedup,
           "op4_html_text": op4_html_text, "op5_licenses": op5_licenses,
           "op6_fingerprints": op6_fingerprints, "op7_language": op7_language,
           "op8_url_rules": op8_url_rules, "op9_hilbert": op9_hilbert,
           "op10_reply_trees": op10_reply_trees, "op11_fill_middle": op11_fill_middle, "op12_quality_votes": op12_quality_votes,
           "op13_structure_repair": op13_structure_repair}
ORACLES = {"op1_decontaminate": decontaminate.SQL, "op3_near_dedup": near_dedup.SQL,
           "op5_licenses": licenses.sql(), "op8_url_rules": url_rules.SQL, "op10_reply_trees": reply_trees.SQL,
           "op11_fill_middle": fill_middle.SQL, "op13_structure_repair": repair.SQL}
