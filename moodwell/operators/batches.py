"""Search for posts and their assignment to batches."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the rows of a preview.
PREVIEW_ROWS = 8


def search_posts(raw: DataFrame, keyword: str) -> DataFrame:
    """Posts with the keyword, or a pattern with ``%`` and ``_``, in keyword or text."""
    pattern = f"%{keyword}%"
    return raw.where(F.col("keyword").ilike(pattern) | F.col("raw_text").ilike(pattern))


def newest(posts: DataFrame, limit: int = 50) -> DataFrame:
    """The newest posts, undated ones first; each task keeps no more than ``limit`` rows."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    return posts.orderBy(F.desc_nulls_first("created_at"), F.desc("id")).limit(limit)


def assign_batch(raw: DataFrame, matched: DataFrame, batch_id: str) -> DataFrame:
    """All posts, the matched ones moved to ``batch_id``.

    Of ``matched`` only the id is read, which no two posts of a table share.
    """
    moved = matched.select("id", F.lit(batch_id).alias("_to")).distinct()
    return (
        raw.join(moved, "id", "left")
        .withColumn("batch_id", F.coalesce("_to", "batch_id"))
        .select(*raw.columns)
    )


def assignment_preview(matched: DataFrame) -> DataFrame:
    """The first matches as they were before the move."""
    return newest(matched, PREVIEW_ROWS)


def drop_batch(
    raw: DataFrame, cleaned: DataFrame, enriched: DataFrame, batch_id: str
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What is left of the three tables without a batch, and how many rows went.

    A cleaned post also goes with its raw post, and an enriched post with its
    cleaned post. The counts are those of the batch in raw and cleaned.
    """
    gone = F.col("batch_id") == batch_id
    raw_gone = raw.where(gone).select(F.col("id").alias("raw_post_id"))
    cleaned_left = cleaned.where(~gone).join(raw_gone, "raw_post_id", "left_anti")
    cleaned_gone = cleaned.join(raw_gone, "raw_post_id", "left_semi").select("id", "batch_id")
    cleaned_gone = cleaned_gone.unionByName(cleaned.where(gone).select("id", "batch_id"))
    enriched_left = enriched.join(
        cleaned_gone.select(F.col("id").alias("cleaned_post_id"), "batch_id"),
        ["cleaned_post_id", "batch_id"],
        "left_anti",
    )
    tagged = raw.where(gone).select(F.lit(1).alias("r"), F.lit(0).alias("c"))
    tagged = tagged.unionByName(cleaned.where(gone).select(F.lit(0).alias("r"), F.lit(1).alias("c")))
    counts = tagged.agg(
        F.coalesce(F.sum("r"), F.lit(0)).alias("raw_deleted"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("cleaned_deleted"),
    )
    return (
        raw.where(~gone),
        cleaned_left.select(*cleaned.columns),
        enriched_left.select(*enriched.columns),
        counts,
    )


def raw_posts_by_batch(raw: DataFrame, batch_id: str | None = None) -> DataFrame:
    """id, batch, keyword and text; the posts of one batch come in order of id."""
    posts = raw.select("id", "batch_id", "keyword", "raw_text")
    if batch_id is None:
        return posts
    return posts.where(F.col("batch_id") == batch_id).orderBy("id")
