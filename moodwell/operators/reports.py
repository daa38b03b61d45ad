"""Reports over the stored tables."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwell.operators.cleaning import in_batch
from moodwell.schemas import EMOTIONS


def joined_posts(
    raw: DataFrame,
    cleaned: DataFrame,
    enriched: DataFrame,
    batch_id: str | None = None,
    same_ids: bool = False,
) -> DataFrame:
    """Raw posts with their cleaned text and score, if any.

    Scores are joined to cleaned posts before the raw posts come in, so the raw
    text, the widest column, is shuffled once. With ``same_ids``, right for tables
    filled by this package, where a cleaned post has the id of its raw post, both
    joins share their keys and the cleaned text is shuffled once as well. One
    batch is listed newest id first.
    """
    key = "raw_post_id" if same_ids else "cleaned_id"
    scores = in_batch(enriched, batch_id).select(
        F.col("cleaned_post_id").alias(key),
        "batch_id",
        "emotion_label",
        "confidence",
        "analyzed_at",
    )
    texts = in_batch(cleaned, batch_id).select(
        F.col("id").alias("cleaned_id"), "raw_post_id", "batch_id", "cleaned_text", "language"
    )
    posts = in_batch(raw, batch_id).select(
        F.col("id").alias("raw_post_id"), "batch_id", "raw_text", "keyword"
    )
    scored = texts.join(scores, [key, "batch_id"], "left")
    rows = posts.join(scored, ["raw_post_id", "batch_id"], "left").select(
        "raw_post_id",
        "batch_id",
        "raw_text",
        "keyword",
        "cleaned_text",
        "language",
        "emotion_label",
        "confidence",
        "analyzed_at",
    )
    return rows if batch_id is None else rows.orderBy(F.desc("raw_post_id"))


def batch_results(enriched: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Scores with the number of results; those of one batch come latest first."""
    rows = in_batch(enriched, batch_id)
    counted = rows.agg(F.count("*").alias("n"))
    # A scalar subquery: no join by batch, which a large batch would skew.
    rows = rows.withColumn("total_results", counted.scalar())
    return rows if batch_id is None else rows.orderBy(F.desc("analyzed_at"), F.desc("id"))


def hero_counts(rows: DataFrame) -> DataFrame:
    """total, analyzed and pending of joined posts per batch."""
    labelled = F.coalesce(F.col("emotion_label"), F.lit("")) != ""
    return rows.groupBy("batch_id").agg(
        F.count("*").alias("total"),
        F.count_if(labelled).alias("analyzed"),
        F.count_if(~labelled).alias("pending"),
    )


def _emotion_counts(rows: DataFrame) -> DataFrame:
    """One column per emotion with its posts per batch; other labels do not count."""
    label = F.lower(F.coalesce(F.col("emotion_label"), F.lit("")))
    return rows.groupBy("batch_id").agg(*[F.count_if(label == e).alias(e) for e in EMOTIONS])


def emotion_distribution(rows: DataFrame) -> DataFrame:
    """Posts of each of the seven emotions per batch, 0 included, in fixed order."""
    entries = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(e.capitalize()).alias("emotion"),
            F.col(e).alias("posts"),
        )
        for position, e in enumerate(EMOTIONS, 1)
    ]
    return _emotion_counts(rows).select("batch_id", F.inline(F.array(*entries)))


def emotion_share(rows: DataFrame) -> DataFrame:
    """``emotion_distribution`` with the share of each emotion in its batch."""
    total = reduce(lambda a, b: a + b, [F.col(e) for e in EMOTIONS])

    def percent(e: str) -> Column:
        share = F.round(F.try_divide(F.col(e) * 100.0, total), 4)
        return F.coalesce(share, F.lit(0.0))

    entries = [
        F.struct(
            F.lit(e.capitalize()).alias("emotion"),
            F.col(e).alias("posts"),
            percent(e).alias("percent"),
        )
        for e in EMOTIONS
    ]
    return _emotion_counts(rows).select("batch_id", F.inline(F.array(*entries)))


def emotion_percentage(enriched: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Posts and percent per batch and emotion, most frequent first within a batch."""
    counts = in_batch(enriched, batch_id).groupBy("batch_id", "emotion_label").agg(
        F.count("*").alias("posts")
    )
    totals = counts.groupBy("batch_id").agg(F.sum("posts").alias("total"))
    return (
        counts.join(totals, "batch_id")
        .select(
            "batch_id",
            "emotion_label",
            "posts",
            F.round(F.col("posts") / F.col("total") * 100, 2).alias("percentage"),
        )
        .orderBy("batch_id", F.desc("posts"), "emotion_label")
    )


def confidence_by_emotion(enriched: DataFrame) -> DataFrame:
    """Average, lowest and highest confidence per emotion, highest average first."""
    confidence = F.col("confidence").cast("double")
    # The sum of decimals is exact, whatever order the tasks add in.
    average = F.sum("confidence").cast("double") / F.count("confidence")
    return (
        enriched.groupBy("emotion_label")
        .agg(
            F.count("*").alias("posts"),
            F.round(average, 4).alias("avg_confidence"),
            F.min(confidence).alias("min_confidence"),
            F.max(confidence).alias("max_confidence"),
        )
        .orderBy(F.desc("avg_confidence"), "emotion_label")
    )


def emotion_by_batch(enriched: DataFrame) -> DataFrame:
    """Posts and average confidence per batch and emotion."""
    average = F.sum("confidence").cast("double") / F.count("confidence")
    return (
        enriched.groupBy("batch_id", "emotion_label")
        .agg(F.count("*").alias("posts"), F.round(average, 4).alias("avg_confidence"))
        .orderBy("batch_id", F.desc("posts"), "emotion_label")
    )


def posts_per_batch(posts: DataFrame) -> DataFrame:
    return posts.groupBy("batch_id").agg(F.count("*").alias("posts")).orderBy("batch_id")


def status_breakdown(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("batch_id", "status").agg(F.count("*").alias("posts"))


def distinct_counts(raw: DataFrame) -> DataFrame:
    """Number of batches, platforms and keywords, in one row."""
    return raw.agg(
        F.count_distinct("batch_id").alias("batches"),
        F.count_distinct("platform").alias("platforms"),
        F.count_distinct("keyword").alias("keywords"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each named table."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


# The first line of the batch report.
TOTAL_LINE = "Total Raw Posts"


def batch_count_report(raw: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Posts in all and in each labelled batch, 0 included, from a single scan."""
    totals = raw.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("batch_id") == b).alias(f"n{i}") for i, b in enumerate(labels)],
    )
    entries = [F.struct(F.lit(TOTAL_LINE).alias("metric"), F.col("total").alias("posts"))]
    entries += [
        F.struct(F.lit(label).alias("metric"), F.col(f"n{i}").alias("posts"))
        for i, label in enumerate(labels.values())
    ]
    return totals.select(F.inline(F.array(*entries)))


def sample_posts(posts: DataFrame, text_col: str, limit: int = 5, chars: int = 70) -> DataFrame:
    """The first posts by id with the head of their text."""
    return (
        posts.select("id", "batch_id", F.substring(text_col, 1, chars).alias(text_col))
        .orderBy("id", "batch_id")
        .limit(limit)
    )


def json_field(df: DataFrame, json_col: str, field: str) -> DataFrame:
    """Add a whole number read from a JSON column; null where there is none."""
    value = F.get_json_object(json_col, f"$.{field}")
    return df.withColumn(field, value.try_cast("bigint"))
