"""From raw documents to encoded training texts: five stages, each written before the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwell.llm import bytelang, ordermin, pieces, sentences, winnow
from moodwell.llm.common import table, written


def _set_aside(docs: DataFrame, names: list[str]) -> DataFrame:
    """The documents with their own columns of some names under others, out of an operator's way."""
    return docs.withColumnsRenamed({name: f"_own_{name}" for name in names if name in docs.columns})


def _as_before(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of ``docs``, those set aside under their names again."""
    own = {name: f"_own_{name}" if f"_own_{name}" in changed.columns else name for name in docs.columns}
    return changed.select(*[F.col(held).alias(name) for name, held in own.items()])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language can be told (null, or without a letter) go; others without
    a given language get the predicted one. Repeated rows are each kept; other columns, whatever
    their names, stay as they are."""
    tagger = bytelang.train_tagger(docs.where(~bytelang.held_out(F.col("doc_id"), 3, 1)))
    tagged = bytelang.identify(_set_aside(docs, ["lang_pred", "score"]), tagger)
    told = tagged.where(F.col("lang_pred") != bytelang.UNKNOWN)
    kind = docs.schema["lang"].dataType
    return _as_before(docs, told.withColumn("lang", F.coalesce("lang", F.col("lang_pred").cast(kind))))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the least id stays."""
    return ordermin.keep_one_each(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has go; what is left stays, with its length. A null text
    stays null; other columns, whatever their names, stay as they are."""
    cut = sentences.remove_repeats(_set_aside(docs, ["n_sentences", "n_removed"]))
    shorter = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    kind = docs.schema["n_chars"].dataType
    return _as_before(docs, cut.withColumn("n_chars", shorter.cast(kind)))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents a twentieth of whose words stand in runs of benchmark items go."""
    return winnow.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text that is left, as ids, and read back from them as ``decoded``."""
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    kept = docs.select("doc_id", "lang", "source", "text")
    return pieces.encode_and_decode(kept, model)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("repeats", drop_repeats),
    ("benchmark", decontaminate),
    ("pieces", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
