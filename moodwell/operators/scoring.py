"""Emotion scoring of cleaned posts and the choice of the posts to score."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwell.functions.chars import is_blank
from moodwell.functions.emotions import (
    lexicon_scorer,
    neutral_scores,
    normalize_scores,
    top_emotion,
    top_score,
)
from moodwell.operators.cleaning import in_batch
from moodwell.operators.once import compute_once
from moodwell.schemas import EMOTIONS

Scorer = Callable[[Column], Column]


def label_scores(df: DataFrame, scores_col: str = "scores") -> DataFrame:
    """Add emotion_label, confidence and the seven emotions; null scores mean neutral."""
    by_emotion = F.when(F.col(scores_col).isNull(), neutral_scores()).otherwise(
        normalize_scores(F.col(scores_col))
    )
    return (
        compute_once(df.withColumn("_by", by_emotion), "_by")
        .withColumns(
            {"emotion_label": top_emotion(F.col("_by")), "confidence": top_score(F.col("_by"))}
        )
        .select(
            *df.columns, "emotion_label", "confidence", *[F.col(f"_by.{e}") for e in EMOTIONS]
        )
    )


def score_posts(
    df: DataFrame, scorer: Scorer | None = None, text_col: str = "cleaned_text"
) -> DataFrame:
    """Label every row and add ``scoring_failed``, to be counted by the caller.

    Blank text is neutral and not sent to the scorer; so is text whose scoring failed.
    """
    scorer = scorer or lexicon_scorer()
    text = F.col(text_col)
    blank = is_blank(text)
    scored = compute_once(df.withColumn("_scores", scorer(F.when(~blank, text))), "_scores")
    failed = scored.withColumn("scoring_failed", ~blank & F.col("_scores").isNull())
    return label_scores(failed, "_scores").drop("_scores")


def unanalyzed(
    cleaned: DataFrame,
    enriched: DataFrame,
    batch_id: str | None = None,
    lang: str | None = "en",
    skip_empty: bool = False,
) -> DataFrame:
    """Cleaned posts in ``lang`` without a score.

    A cleaned post is known by its id, whatever its batch. The empty text of a
    rejected post is scored (as neutral) unless ``skip_empty``.
    """
    posts = in_batch(cleaned, batch_id)
    if lang is not None:
        posts = posts.where(F.col("language") == lang)
    if skip_empty:
        posts = posts.where(F.col("cleaned_text") != "")
    done = enriched.select(F.col("cleaned_post_id").alias("id"))
    return posts.join(done, "id", "left_anti")


def to_enriched(scored: DataFrame, analyzed_at: Column) -> DataFrame:
    """Rows for the enriched table from labelled posts with ``id`` and ``batch_id``."""
    stored = F.col("confidence").cast("decimal(3,2)")
    return scored.select(
        "id",
        F.col("id").alias("cleaned_post_id"),
        "batch_id",
        "emotion_label",
        stored.alias("confidence"),
        stored.alias("emotion_intensity"),
        F.struct(*EMOTIONS).alias("emotion_distribution_data"),
        analyzed_at.cast("timestamp_ntz").alias("analyzed_at"),
    )


def enrich_stage(
    cleaned: DataFrame,
    enriched: DataFrame,
    analyzed_at: Column,
    scorer: Scorer | None = None,
    batch_id: str | None = None,
    skip_empty: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Rows for the enriched table: all posts to score, or the first ``limit`` by id.

    A post whose scoring failed has no row, so that a later run tries it again.
    """
    posts = unanalyzed(cleaned, enriched, batch_id, skip_empty=skip_empty)
    if limit is not None:
        posts = posts.orderBy("id", "batch_id").limit(limit)
    scored = score_posts(posts.select("id", "batch_id", "cleaned_text"), scorer)
    return to_enriched(scored.where(~F.col("scoring_failed")), analyzed_at)
