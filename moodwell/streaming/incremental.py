"""Cleaning and scoring of raw posts as they arrive."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from moodwell.functions.moments import moment
from moodwell.operators.cleaning import clean_stage
from moodwell.operators.language import LanguageModel
from moodwell.operators.scoring import Scorer, enrich_stage
from moodwell.schemas import CLEANED_POSTS, ENRICHED_POSTS, RAW_POSTS
from moodwell.sources.tables import append_posts, ensure_table, read_posts

#: The column for the time at which a post's file was written.
WRITTEN = "written_at"
#: How far the clocks of those who write files may differ from the driver's.
CLOCKS = timedelta(minutes=10)


def watch_raw_posts(
    spark: SparkSession, raw_path: str, max_files: int | None = None
) -> DataFrame:
    """New files of the raw table as a stream, with the time at which each was written."""
    reader = spark.readStream.schema(RAW_POSTS)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    posts = reader.parquet(raw_path)
    return posts.select("*", F.col("_metadata.file_modification_time").alias(WRITTEN))


def _moments(column: str, since: datetime):
    """Whether a moment without a zone, in UTC, is missing or before ``since``."""
    return F.coalesce(F.col(column) < moment(since), F.lit(True))


def clean_and_score_stream(
    raw_stream: DataFrame,
    cleaned_path: str,
    enriched_path: str,
    checkpoint: str,
    model: LanguageModel | None = None,
    scorer: Scorer | None = None,
    every: str | None = None,
    remember: timedelta = timedelta(days=1),
) -> StreamingQuery:
    """Start a query that handles what has arrived and stops or, with ``every``, goes on.

    ``every`` is an interval such as ``"1 minute"``.

    A post that comes again, say since its batch was rewritten, is left out. The query's
    state holds the ids of the posts that arrived in the time to ``remember``, a few bytes
    each; the work of a micro-batch then follows from its own rows, however long the tables
    are. Only what the state cannot know is looked up in the tables, by the range of its ids:
    posts from files written before this start of the query, which a run before may have
    handled in part, and posts fetched longer ago than is remembered. Other runs must not
    clean the same new posts at the same time.
    """
    spark = raw_stream.sparkSession
    ensure_table(spark, cleaned_path, CLEANED_POSTS)
    ensure_table(spark, enriched_path, ENRICHED_POSTS)
    started = datetime.now(timezone.utc)
    if WRITTEN not in raw_stream.columns:
        raw_stream = raw_stream.withColumn(WRITTEN, F.lit(None).cast("timestamp"))

    def handle(posts: DataFrame, _: int) -> None:
        spark = posts.sparkSession
        now = datetime.now(timezone.utc)
        posts = posts.persist()
        before_start = F.col(WRITTEN) < F.lit(started + CLOCKS)
        unsure = F.coalesce(before_start, F.lit(True)) | _moments("fetched_at", now - remember + CLOCKS)
        ids = posts.agg(
            F.count("*").alias("posts"),
            F.min(F.when(unsure, F.col("id"))).alias("least"),
            F.max(F.when(unsure, F.col("id"))).alias("most"),
        ).first()

        def known(path: str, schema: T.StructType) -> DataFrame:
            if ids.least is None:
                return spark.createDataFrame([], schema)
            return read_posts(spark, path, schema).where(F.col("id").between(ids.least, ids.most))

        try:
            if not ids.posts:  # only the state grows older
                return
            cleaned = clean_stage(posts, None, moment(now), model=model).persist()
            there = known(cleaned_path, CLEANED_POSTS).select("id")
            append_posts(cleaned.join(there, "id", "left_anti").select(*cleaned.columns), cleaned_path)
            scored = known(enriched_path, ENRICHED_POSTS)
            rows = enrich_stage(cleaned, scored, moment(now), scorer)
            # A task of the state holds posts of all batches. Scores are short, so that they are moved
            # before a file is made of each batch in each task; a large batch takes as many tasks as
            # there are cores.
            spread = F.pmod(F.xxhash64("id"), F.lit(spark.sparkContext.defaultParallelism))
            append_posts(rows.repartition("batch_id", spread), enriched_path)
            cleaned.unpersist()
        finally:
            posts.unpersist()

    # What cleaning needs: all else would be moved to the state's tasks and held there for nothing.
    raw_stream = raw_stream.select("id", "batch_id", "raw_text", "fetched_at", WRITTEN)
    # Times of arrival, since by their own times late posts would be dropped.
    seconds = int((remember + 2 * CLOCKS).total_seconds())
    arrived = raw_stream.withColumn("_arrived", F.current_timestamp()).withWatermark(
        "_arrived", f"{seconds} seconds"
    )
    raw_stream = arrived.dropDuplicatesWithinWatermark(["id"])
    writer = raw_stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()
