"""The three stored tables, laid out so that joins by post read them in place.

Each table is bucketed and sorted by the key of the raw post that its rows belong to, into the same
number of buckets. In tables of this package a cleaned post has the id of its raw post and a score that of
its cleaned post, so buckets of all three meet without a shuffle. A key is a post's own, so that a batch
with most of the posts is spread over all buckets. Tables stand in the session's catalog.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwell.operators.cleaning import in_batch, uncleaned
from moodwell.operators.scoring import unanalyzed

#: The column that each table is bucketed by.
KEYS = {"raw": "id", "cleaned": "raw_post_id", "enriched": "cleaned_post_id"}


def append_bucketed(
    df: DataFrame, prefix: str, stage: str, buckets: int, folder: str | None = None
) -> None:
    """Add rows to the table ``<prefix>_<stage>``, made with the first ones. An action.

    Rows are shuffled by bucket first, so that one append adds one file to a bucket at most. All
    three tables need the same number of buckets, some hundred megabytes of text for each. Files
    go to a folder below ``folder`` or, without one, to the warehouse.
    """
    key = KEYS[stage]
    out = df.repartition(buckets, key).write.mode("append").bucketBy(buckets, key).sortBy(key)
    if folder is not None:
        out = out.option("path", f"{folder}/{prefix}_{stage}")
    out.saveAsTable(f"{prefix}_{stage}")


def compact_bucketed(
    spark: SparkSession, prefix: str, stage: str, into: str, buckets: int, folder: str | None = None
) -> None:
    """Copy a table that took many appends to ``<into>_<stage>``, with one file a bucket. An action."""
    append_bucketed(spark.table(f"{prefix}_{stage}"), into, stage, buckets, folder)


def uncleaned_in_place(spark: SparkSession, prefix: str, batch_id: str | None = None) -> DataFrame:
    """Raw posts without a cleaned post; no table is shuffled."""
    return uncleaned(spark.table(f"{prefix}_raw"), spark.table(f"{prefix}_cleaned"), batch_id)


def unanalyzed_in_place(
    spark: SparkSession, prefix: str, batch_id: str | None = None, lang: str | None = "en"
) -> DataFrame:
    """Cleaned posts in ``lang`` without a score; no table is shuffled."""
    cleaned = spark.table(f"{prefix}_cleaned").withColumn("id", F.col("raw_post_id"))
    return unanalyzed(cleaned, spark.table(f"{prefix}_enriched"), batch_id, lang)


def joined_in_place(spark: SparkSession, prefix: str, batch_id: str | None = None) -> DataFrame:
    """Raw posts with their cleaned text and score, if any; no table is shuffled.

    Rows meet by key alone, since a second join column would ask for buckets of both; what is found
    in another batch is left out. For tables with one cleaned post and one score a key.
    """
    raw = in_batch(spark.table(f"{prefix}_raw"), batch_id).alias("r")
    cleaned, enriched = (spark.table(f"{prefix}_{stage}") for stage in ("cleaned", "enriched"))
    rows = raw.join(cleaned.alias("c"), F.col("r.id") == F.col("c.raw_post_id"), "left")
    rows = rows.join(enriched.alias("e"), F.col("r.id") == F.col("e.cleaned_post_id"), "left")
    same = F.col("r.batch_id") == F.col("c.batch_id")
    scored = same & (F.col("r.batch_id") == F.col("e.batch_id"))
    out = rows.select(
        F.col("r.id").alias("raw_post_id"),
        "r.batch_id",
        "raw_text",
        "keyword",
        *[F.when(same, F.col(name)).alias(name) for name in ("cleaned_text", "language")],
        *[F.when(scored, F.col(name)).alias(name) for name in ("emotion_label", "confidence", "analyzed_at")],
    )
    return out if batch_id is None else out.orderBy(F.desc("raw_post_id"))
