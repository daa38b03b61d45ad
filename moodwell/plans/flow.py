"""Runs that read the stored tables, do one step and append its result. All are actions."""

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from moodwell.functions.ids import ingest_batch_id
from moodwell.functions.moments import moment
from moodwell.operators.batches import assign_batch, newest, search_posts
from moodwell.operators.cleaning import clean_stage, in_batch, uncleaned
from moodwell.operators.ingest import match_comments, to_raw_posts
from moodwell.operators.language import LanguageModel
from moodwell.operators.scoring import Scorer, score_posts, to_enriched, unanalyzed
from moodwell.schemas import CLEANED_POSTS, ENRICHED_POSTS, RAW_POSTS
from moodwell.session import work_folder
from moodwell.sources.keys import keyed_posts
from moodwell.sources.tables import (
    append_posts,
    empty_batch,
    empty_table,
    ensure_table,
    overwrite_batches,
    read_posts,
)

MAX_SENT_KEYS = 1_000_000
MAX_NAMED_BATCHES = 1000


def run_ingestion(
    source: DataFrame,
    raw_path: str,
    keyword: str,
    suffix: str,
    created_at: datetime,
    platform: str = "csv",
    mode: str = "equals",
    limit: int | None = None,
) -> dict:
    """Append the comments for a keyword as a new batch; the outcome as a plain record.

    Posts get keys that no other post of the table has, also if a source is read again for
    another batch. A run that is repeated, after a failure or not, adds what is missing.
    """
    # The names of the fields that a caller reads.
    outcome = {"status": "error", "batch_id": "", "keyword": keyword, "records_inserted": 0}
    if not keyword or not keyword.strip():
        return {**outcome, "message": "no keyword given"}
    spark = source.sparkSession
    batch_id = spark.range(1).select(ingest_batch_id(F.lit(keyword), F.lit(suffix))).first()[0]
    comments = match_comments(source, keyword, mode=mode, limit=limit)
    posts = to_raw_posts(comments, batch_id, keyword, platform, moment(created_at))
    ensure_table(spark, raw_path, RAW_POSTS)
    missing, found = keyed_posts(posts, raw_path, batch_id)
    if not found:
        return {**outcome, "message": f"nothing in the source for {keyword!r}"}
    inserted = append_posts(missing, raw_path)
    return {
        "status": "success",
        "batch_id": batch_id,
        "keyword": keyword,
        "records_inserted": inserted,
        "message": f"{inserted} new posts for {keyword!r}",
    }


def run_assignment(
    spark: SparkSession, raw_path: str, keyword: str, batch_id: str, limit: int = 50
) -> int:
    """Move the newest posts for a keyword to a batch; returns how many.

    Only the batches that lose or gain posts are rewritten. The matches' keys are
    written first, since their batches are replaced while they are read; the
    batches' names, at most ``limit``, prune the scan.
    """
    raw = read_posts(spark, raw_path, RAW_POSTS)
    path = work_folder(spark, "matched")
    newest(search_posts(raw, keyword), limit).select("id", "batch_id").write.parquet(path)
    matched = spark.read.schema("id bigint, batch_id string").parquet(path)
    moved = matched.count()
    if not moved:
        raise ValueError(f"no posts found for keyword: {keyword}")
    names = matched.select("batch_id").distinct().collect()
    losing = {r.batch_id for r in names} - {batch_id}
    # Named batches, so that the scan is pruned to their folders.
    old = raw.where(F.col("batch_id").isin(list(losing)))
    left = old.join(matched, ["id", "batch_id"], "left_anti").select("batch_id").distinct()
    left = {r.batch_id for r in left.collect()}
    changed = raw.where(F.col("batch_id").isin([*losing, batch_id]))
    overwrite_batches(assign_batch(changed, matched, batch_id), raw_path)
    for emptied in losing - left:
        empty_batch(spark, raw_path, RAW_POSTS, emptied)
    return moved


def batches_of(posts: DataFrame, keys: DataFrame) -> DataFrame:
    """The posts of the batches that ``keys`` name; only their folders are read, unless there are many."""
    names = keys.select("batch_id").distinct()
    few = names.limit(MAX_NAMED_BATCHES + 1).collect()
    if len(few) <= MAX_NAMED_BATCHES:
        return posts.where(F.col("batch_id").isin([r.batch_id for r in few]))
    return posts.join(names, "batch_id", "left_semi")


def pick(posts: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """The posts whose ``id`` and ``batch_id`` are wanted, without a shuffle if these are few.

    The keys are found first, from two narrow columns, and written once; then
    the texts of just these posts are read. Their number decides how: up to
    MAX_SENT_KEYS are sent to every task, more are joined by a shuffle.
    """
    spark = posts.sparkSession
    path = work_folder(spark, name)
    wanted.select("id", "batch_id").write.parquet(path)
    keys = spark.read.schema("id bigint, batch_id string").parquet(path)
    few = keys.limit(MAX_SENT_KEYS + 1).count() <= MAX_SENT_KEYS
    posts = batches_of(posts, keys)
    return posts.join(F.broadcast(keys) if few else keys, ["id", "batch_id"], "left_semi")


def run_cleaning(
    spark: SparkSession,
    raw_path: str,
    cleaned_path: str,
    batch_id: str | None,
    processed_at: datetime,
    model: LanguageModel | None = None,
    reclean: bool = False,
) -> dict:
    """Clean the posts of a batch, or of all, not cleaned yet; all anew with ``reclean``."""
    raw = in_batch(read_posts(spark, raw_path, RAW_POSTS), batch_id)
    if raw.isEmpty():
        raise ValueError(f"no raw posts found for batch {batch_id}")
    ensure_table(spark, cleaned_path, CLEANED_POSTS)
    if not reclean:
        cleaned = read_posts(spark, cleaned_path, CLEANED_POSTS)
        raw = pick(raw, uncleaned(raw.select("id", "batch_id"), cleaned), "uncleaned")
    rows = clean_stage(raw, None, moment(processed_at), model=model)
    write = overwrite_batches if reclean else append_posts
    return {"batch_id": batch_id, "total_processed": write(rows, cleaned_path)}


def drop_scores(spark: SparkSession, enriched_path: str, batch_id: str | None) -> int:
    """Remove the scores of a batch, or of all, whose posts are cleaned anew; returns how many."""
    ensure_table(spark, enriched_path, ENRICHED_POSTS)
    if batch_id is not None:
        return empty_batch(spark, enriched_path, ENRICHED_POSTS, batch_id)
    return empty_table(spark, enriched_path, ENRICHED_POSTS)


def run_analysis(
    spark: SparkSession,
    cleaned_path: str,
    enriched_path: str,
    batch_id: str | None,
    analyzed_at: datetime,
    scorer: Scorer | None = None,
    skip_empty: bool = False,
) -> dict:
    """Score the posts of a batch, or of all, not scored yet.

    Posts whose scoring failed are counted and left for a later run.
    """
    cleaned = in_batch(read_posts(spark, cleaned_path, CLEANED_POSTS), batch_id)
    if cleaned.isEmpty():
        raise ValueError(f"no cleaned posts found for batch {batch_id}")
    ensure_table(spark, enriched_path, ENRICHED_POSTS)
    enriched = read_posts(spark, enriched_path, ENRICHED_POSTS)
    posts = pick(cleaned, unanalyzed(cleaned, enriched, skip_empty=skip_empty), "unanalyzed")
    counted, failed = Observation(), F.col("scoring_failed")
    scored = score_posts(posts, scorer).observe(counted, F.count_if(failed).alias("failed"))
    rows = to_enriched(scored.where(~failed), moment(analyzed_at))
    processed = append_posts(rows, enriched_path)
    return {"batch_id": batch_id, "processed": processed, "failed": counted.get["failed"]}


def run_all(
    spark: SparkSession,
    raw_path: str,
    cleaned_path: str,
    enriched_path: str,
    batch_id: str | None,
    at: datetime,
    model: LanguageModel | None = None,
    scorer: Scorer | None = None,
    reclean: bool = False,
) -> dict:
    """Clean, then score a batch or, without one, whatever is left to do; all anew with ``reclean``.

    Old scores go first: if the run stops, posts without scores are left, which a later run sees.
    """
    if reclean:
        drop_scores(spark, enriched_path, batch_id)
    cleaned = run_cleaning(spark, raw_path, cleaned_path, batch_id, at, model, reclean)
    scored = run_analysis(spark, cleaned_path, enriched_path, batch_id, at, scorer)
    return {**cleaned, **scored}
