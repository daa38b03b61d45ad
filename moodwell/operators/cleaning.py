"""Cleaning of posts and the choice of the posts to clean."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwell.functions import rules
from moodwell.functions.chars import is_blank, strip, without
from moodwell.functions.language import DEFAULT_LANGUAGE
from moodwell.functions.symbols import name_symbols, unsettled
from moodwell.operators.language import LanguageModel, detect_language
from moodwell.operators.once import compute_once
from moodwell.schemas import FLAGS

# Rules that set a flag: each of them changes the text whenever it applies.
FLAGGED_RULES = {
    "had_urls": rules.strip_urls,
    "had_mentions": rules.strip_mentions,
    "had_hashtags": rules.expand_hashtags,
    "encoding_issue": rules.fix_entities,
}

QUIET_RULES = [
    rules.tidy,
    rules.breaks_to_spaces,
    rules.collapse_spaces,
    strip,
]


def normalize_text(df: DataFrame, text_col: str) -> DataFrame:
    """Add ``_text``, the text after all rewriting rules, and one column per flag."""
    text = F.col(text_col)
    out = df.withColumn("_given", F.when(~is_blank(text), text))
    out = compute_once(out.withColumn("_suspect", unsettled(F.col("_given"))), "_given", "_suspect")
    out = out.withColumn("_spelled", name_symbols(F.col("_given"), F.col("_suspect")))
    out = out.withColumns(
        {"_text": F.col("_spelled.text"), "_had_emojis": F.col("_spelled.named")}
    )
    for flag, rule in FLAGGED_RULES.items():
        out = out.withColumn("_next", rule(F.col("_text"))).withColumns(
            {f"_{flag}": F.col("_next") != F.col("_text"), "_text": F.col("_next")}
        )
    for rule in QUIET_RULES:
        out = out.withColumn("_text", rule(F.col("_text")))
    return out.drop("_given", "_suspect", "_spelled", "_next")


def flags_of(is_set: Callable[[str], Column]) -> Column:
    """The flags that are set, in their fixed order."""
    found = F.array(*[F.when(is_set(flag), flag) for flag in FLAGS])
    # Unlike array_compact, which runs a lambda, this stays inside generated code.
    return F.array_except(found, F.array(F.lit(None).cast("string")))


def status_of(text: Column, spaced: Column, letters: Column) -> Column:
    """Status of a rewritten text; the first test that applies decides."""
    return (
        F.when(~F.coalesce(rules.has_words(text), F.lit(False)), "too_short")
        .when(rules.is_gibberish(spaced, letters, F.length(text)), "gibberish")
        .when(~rules.is_latin(text, letters), "non_latin_script")
        .otherwise("ok")
    )


def clean_posts(
    df: DataFrame, text_col: str = "raw_text", model: LanguageModel | None = None
) -> DataFrame:
    """Add cleaned_text, language, emoji_converted, status and flags to every row.

    A narrow transformation: rows are neither moved nor dropped. Without a
    language model every post counts as the default language.
    """
    out = normalize_text(df, text_col)
    if model is None:
        out = out.withColumns(
            {"language": F.lit(DEFAULT_LANGUAGE), "_mixed_language": F.lit(False)}
        )
    else:
        out = detect_language(
            compute_once(
                out.withColumn("_plain", without(F.col("_text"), rules.PLACEHOLDER)),
                "_text",
                "_plain",
            ),
            model,
            "_plain",
            "language",
            "_mixed_language",
        ).drop("_plain")
    text, letters = F.col("_text"), F.col("_letters")
    out = out.withColumns(
        {"_letters": rules.letter_count(text), "_spaced": rules.single_spaced(text)}
    ).withColumns(
        {
            "_all_caps": rules.is_all_caps(text, letters),
            "status": status_of(text, F.col("_spaced"), letters),
        }
    )
    results = ["cleaned_text", "language", "emoji_converted", "status", "flags"]
    out = out.select(
        *[c for c in df.columns if c not in results],
        F.when(F.col("status").isin("ok", "non_latin_script"), text).alias("cleaned_text"),
        "language",
        F.col("_had_emojis").alias("emoji_converted"),
        "status",
        flags_of(lambda flag: F.col(f"_{flag}")).alias("flags"),
    )
    return compute_once(out, *results)


def in_batch(df: DataFrame, batch_id: str | None) -> DataFrame:
    """The rows of one batch, or all rows; prunes the partitions of a stored table."""
    return df if batch_id is None else df.where(F.col("batch_id") == batch_id)


def uncleaned(raw: DataFrame, cleaned: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Raw posts without a cleaned post, in whatever batch that may be."""
    done = cleaned.select(F.col("raw_post_id").alias("id"))
    return in_batch(raw, batch_id).join(done, "id", "left_anti")


def clean_stage(
    raw: DataFrame,
    cleaned: DataFrame | None,
    processed_at: Column,
    batch_id: str | None = None,
    model: LanguageModel | None = None,
) -> DataFrame:
    """Rows for the cleaned table.

    With ``cleaned`` only posts not cleaned yet, so a repeated run adds nothing;
    with None every post, as a rewrite of the batches needs. A post is cleaned
    once per batch, hence its id serves again: unique within the batch and the
    same in every attempt of a task.
    """
    posts = in_batch(raw, batch_id)
    if cleaned is not None:
        posts = uncleaned(posts, cleaned)
    return clean_posts(posts.select("id", "batch_id", "raw_text"), "raw_text", model).select(
        "id",
        F.col("id").alias("raw_post_id"),
        "batch_id",
        F.coalesce("cleaned_text", F.lit("")).alias("cleaned_text"),
        "language",
        "emoji_converted",
        "status",
        "flags",
        processed_at.cast("timestamp_ntz").alias("processed_at"),
    )


def clean_response(cleaned: DataFrame) -> DataFrame:
    """What a caller sees of freshly cleaned posts: one row each, unstored text as null."""
    return cleaned.select(
        F.col("raw_post_id").alias("post_id"),
        "batch_id",
        F.when(F.col("status").isin("ok", "non_latin_script"), F.col("cleaned_text")).alias(
            "cleaned_text"
        ),
        "language",
        "emoji_converted",
        "status",
        "flags",
    )
