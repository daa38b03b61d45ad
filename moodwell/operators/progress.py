"""Progress of cleaning and scoring."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodwell.operators.cleaning import in_batch
from moodwell.operators.scoring import unanalyzed


def _paired_counts(
    whole: DataFrame, done: DataFrame, batch_id: str | None, total: str, finished: str
) -> DataFrame:
    """Rows of two tables per batch; only sums per task and batch are shuffled."""
    marked = in_batch(whole, batch_id).select("batch_id", F.lit(1).alias("w"), F.lit(0).alias("d"))
    marked = marked.unionByName(
        in_batch(done, batch_id).select("batch_id", F.lit(0).alias("w"), F.lit(1).alias("d"))
    )
    return (
        marked.groupBy("batch_id")
        .agg(F.sum("w").alias(total), F.sum("d").alias(finished))
        .withColumn("pending", F.col(total) - F.col(finished))
    )


def cleaning_stats(
    raw: DataFrame, cleaned: DataFrame, batch_id: str | None = None
) -> DataFrame:
    """total_raw, cleaned, pending and percent done per batch.

    Pending is a plain difference: below 0 for a batch that lost posts to another.
    """
    return _paired_counts(raw, cleaned, batch_id, "total_raw", "cleaned").withColumn(
        "completion_pct", F.round(F.try_divide(F.col("cleaned"), F.col("total_raw")) * 100, 1)
    )


def analysis_stats(
    cleaned: DataFrame, enriched: DataFrame, batch_id: str | None = None
) -> DataFrame:
    """total_posts, analyzed and pending per batch; posts in any language count."""
    return _paired_counts(cleaned, enriched, batch_id, "total_posts", "analyzed")


def fleet_status(cleaned: DataFrame, enriched: DataFrame) -> DataFrame:
    """total_enriched and the posts still to score, over all batches, in one row."""
    pending = unanalyzed(cleaned, enriched).agg(F.count("*").alias("pending"))
    return enriched.agg(F.count("*").alias("total_enriched")).withColumn(
        "pending", pending.scalar()
    )


def unanalyzed_by_batch(cleaned: DataFrame, enriched: DataFrame) -> DataFrame:
    """Posts without a score per batch, in any language."""
    return (
        unanalyzed(cleaned, enriched, lang=None)
        .groupBy("batch_id")
        .agg(F.count("*").alias("unanalyzed"))
    )
