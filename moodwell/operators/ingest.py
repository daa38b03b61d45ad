"""From source comments to raw posts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwell.functions.chars import strip


def match_comments(
    source: DataFrame,
    keyword: str,
    key_col: str = "device",
    text_col: str = "comment",
    id_col: str = "comment_id",
    mode: str = "equals",
    limit: int | None = None,
) -> DataFrame:
    """``id, comment`` of the rows for a keyword, comments stripped.

    ``equals`` compares without case and outer white space and drops empty
    comments before stripping; ``ilike`` takes the keyword as a pattern and
    drops nulls only. ``limit`` keeps the first rows by id.
    """
    keyword = keyword.strip()
    if not keyword:
        raise ValueError("keyword must not be empty")
    key, text = F.col(key_col), F.col(text_col)
    if mode == "equals":
        matched = F.lower(strip(F.coalesce(key, F.lit("")))) == keyword.lower()
        kept = text.isNotNull() & (text != "")
    elif mode == "ilike":
        matched, kept = key.ilike(keyword), text.isNotNull()
    else:
        raise ValueError(f"unknown mode {mode}")
    rows = source.where(matched & kept).select(
        F.col(id_col).alias("id"), strip(text).alias("comment")
    )
    return rows if limit is None else rows.orderBy("id").limit(limit)


def to_raw_posts(
    comments: DataFrame, batch_id: str, keyword: str, platform: str, created_at: Column
) -> DataFrame:
    """Rows for the raw table: one batch, one moment."""
    moment = created_at.cast("timestamp_ntz")
    return comments.select(
        "id",
        F.lit(batch_id).alias("batch_id"),
        F.lit(platform).alias("platform"),
        F.lit(keyword).alias("keyword"),
        F.col("comment").alias("raw_text"),
        moment.alias("created_at"),
        F.lit("{}").alias("raw_json"),
        moment.alias("fetched_at"),
    )


def with_raw_json(df: DataFrame) -> DataFrame:
    """Complete posts that miss optional fields and pack three of them as JSON."""

    def optional(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in df.columns else default

    packed = F.to_json(
        F.struct(
            optional("upvotes", F.lit(100)).alias("upvotes"),
            optional("emotion", F.lit("neutral")).alias("emotion"),
            optional("characteristic", F.lit("standard")).alias("characteristic"),
        )
    )
    kept = [c for c in df.columns if c not in ("upvotes", "emotion", "characteristic")]
    return (
        df.withColumn("raw_json", packed)
        .select(*kept, "raw_json")
        .withColumn("platform", optional("platform", F.lit("reddit")))
        .withColumn("keyword", optional("keyword", F.lit("")))
    )


# Emoji that the simple cleaning of the sample data knows, where
# the heart's style mark stands as a character of its own.
SIMPLE_EMOJI = "😊😠😨🤢😲😞😟🚀💚🤮🌍❤️😤😄😡😂💔🔥✨"


def simple_clean(text: Column) -> Column:
    """Lower case, single spaces, and the first known emoji (only that one) removed."""
    first_gone = F.regexp_replace(text, rf"(?s)\A(.*?)[{SIMPLE_EMOJI}]", "$1")
    return F.lower(F.regexp_replace(first_gone, r"\s+", " "))


def simple_clean_posts(raw: DataFrame, first_id: int, last_id: int) -> DataFrame:
    """Cleaned rows for the raw posts in a range of ids."""
    return raw.where(F.col("id").between(first_id, last_id)).select(
        F.col("id").alias("raw_post_id"),
        "batch_id",
        simple_clean(F.col("raw_text")).alias("cleaned_text"),
        F.lit("en").alias("language"),
        F.lit(True).alias("emoji_converted"),
    )
