"""One query per operator, on whole tables, with the digests that stand for its results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwell.llm import bilinear, bytelang, chat, licenses, ordermin, pieces, postings, sentences, shards, urlrules, variants, winnow, wordruns
from moodwell.llm.common import table
from moodwell.llm.oracles import DECONTAMINATE_SQL, URL_FILTER_SQL

Query = Callable[[SparkSession, str], DataFrame]

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document, by a model of six sevenths of them."""
    docs = table(spark, sf_dir, "documents")
    return bilinear.score_texts(docs, bytelang.held_out(F.col("doc_id"), 7, 2))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest vectors of every twentieth one."""
    return postings.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and decoded text of every document, by digest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.piece_digests(docs, pieces.read_model(PIECES)).drop("text")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    kept_back = bytelang.held_out(F.col("doc_id"), 3, 1)
    tagger = bytelang.train_tagger(docs.where(~kept_back))
    read = docs.select("doc_id", kept_back.alias("held_out"), "text")
    return bytelang.identify(read, tagger).drop("text")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and notices in every document."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which benchmark items each document holds runs of."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = winnow.find_contamination(docs, items)
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        digest.alias("items_sha256"),
        winnow.is_contaminated().alias("contaminated"),
    )


def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards of near equal size."""
    placed = shards.assign_shards(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier one has."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentences.remove_repeats(docs)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one full of control strings, read back from its tokens."""
    columns = ["conv_id", "turn", "role", "text"]
    turns = table(spark, sf_dir, "conversations").select(*columns)
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    ranks, pattern = pieces.read_model(RANKS), public_tokenizers.PATTERN
    formatted = chat.format_turns(turns.unionByName(probe), ranks, pattern)
    return chat.read_back(formatted, ranks, pattern)


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near copies that each document belongs to."""
    found = ordermin.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "class_size", "kept")


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict of rules on the address of every page."""
    return urlrules.filter_urls(table(spark, sf_dir, "pages"), urlrules.rule_table(spark))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document, a tenth of which get some planted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = wordruns.find_runs(wordruns.with_planted_runs(docs, "doc_id", "text"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", wordruns.longest_run(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")],
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, some of them misspelt on purpose, with their common forms."""
    docs = table(spark, sf_dir, "documents")
    return variants.group_variants(variants.count_words(docs, slips=97))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_lm_score,
        op2_nearest_neighbours,
        op3_sentencepiece,
        op4_language_id,
        op5_license_scan,
        op6_decontaminate,
        op7_shard,
        op8_substring_dedup,
        op9_chat_format,
        op10_near_duplicates,
        op11_url_filter,
        op12_periodic_runs,
        op13_spelling_variants,
    )
}
ORACLES: dict[str, str] = {
    "op6_decontaminate": DECONTAMINATE_SQL,
    "op11_url_filter": URL_FILTER_SQL,
}
