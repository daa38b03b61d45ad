"""Filters and display columns over joined posts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwell.functions.chars import SPACE, strip

# Lengths of shortened texts, and the label of a post without a score.
RAW_CHARS = 180
CLEANED_CHARS = 160
NO_LABEL = "pending"


def matches_text(needle: str, literal: bool = False) -> Column:
    """Whether raw or cleaned text holds the needle, a regular expression by default."""
    needle = needle.lower().strip()

    def found(column: str) -> Column:
        text = F.lower(F.coalesce(F.col(column), F.lit("")))
        return text.contains(needle) if literal else text.rlike(needle)

    return found("raw_text") | found("cleaned_text")


def numeric_confidence() -> Column:
    """Confidence as a number, 0 for null and for what is not a number."""
    return F.coalesce(F.col("confidence").try_cast("double"), F.lit(0.0))


def explore(
    rows: DataFrame,
    text: str | None = None,
    emotion: str = "all",
    min_confidence: float = 0.0,
    literal: bool = False,
) -> DataFrame:
    """The joined posts that pass all filters, confidence made numeric.

    The filters sit on a plain DataFrame: Catalyst moves those on the raw side below the joins.
    """
    out = rows
    if text:
        out = out.where(matches_text(text, literal))
    if emotion != "all":
        out = out.where(F.lower(F.coalesce(F.col("emotion_label"), F.lit(""))) == emotion)
    out = out.withColumn("confidence", numeric_confidence())
    return out.where(F.col("confidence") >= min_confidence)


def shorten(text: Column, max_chars: int) -> Column:
    """Stripped text; if longer than ``max_chars``, cut and closed with three dots."""
    value = strip(F.coalesce(text, F.lit("")))
    head = F.substring(value, 1, max_chars - 3)
    # Only the end is trimmed: the value starts with no space.
    cut = F.concat(F.regexp_replace(head, rf"{SPACE}+\z", ""), F.lit("..."))
    return F.when(F.length(value) <= max_chars, value).otherwise(cut)


def display(explored: DataFrame) -> DataFrame:
    """What a reader sees of each explored post."""
    return explored.select(
        "raw_post_id",
        shorten(F.col("raw_text"), RAW_CHARS).alias("raw_text"),
        shorten(F.col("cleaned_text"), CLEANED_CHARS).alias("cleaned_text"),
        F.lower(
            F.when(F.coalesce(F.col("emotion_label"), F.lit("")) == "", NO_LABEL).otherwise(
                F.col("emotion_label")
            )
        ).alias("emotion"),
        F.round(F.col("confidence") * 100, 1).alias("confidence_pct"),
        F.coalesce("keyword", F.lit("")).alias("keyword"),
    )


def newest_first(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.desc("raw_post_id"))


def shown_counts(rows: DataFrame, explored: DataFrame) -> DataFrame:
    """How many of the rows are shown, in one row."""
    shown = explored.agg(F.count("*").alias("shown"))
    return rows.agg(F.count("*").alias("total")).withColumn("shown", shown.scalar())
