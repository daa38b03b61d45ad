"""Deletion of a batch from the three stored tables, which a stopped run can take up again.

The keys of all rows to go are written before any row goes, since cleaned and enriched posts are
found through raw ones. Then children go before parents. A log names each step that is done;
a later run for the same batch skips these and goes on with the keys of the run that stopped.
Every step gives the same result when it is done again.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwell.plans.flow import batches_of
from moodwell.schemas import CLEANED_POSTS, ENRICHED_POSTS, RAW_POSTS
from moodwell.sources.tables import empty_batch, ensure_table, overwrite_batches, read_posts

LOG = "batch_id string, run string, step string"
KEYS = "stage string, id long, batch_id string, own boolean"
#: The steps of a run, in order; the last one ends it.
STEPS = ["keys", "enriched", "cleaned", "raw"]


def keys_to_delete(
    raw: DataFrame, cleaned: DataFrame, enriched: DataFrame, batch_id: str
) -> DataFrame:
    """``stage, id, batch_id, own`` of the rows that go with a batch; ``own``: they are in it.

    A cleaned post goes with its batch or its raw post, an enriched post with its cleaned post.
    """
    gone = F.col("batch_id") == batch_id
    raw_keys = raw.where(gone).select("id", "batch_id")
    own = cleaned.where(gone).select("id", "batch_id")
    by_raw = cleaned.where(~gone).join(raw_keys.select(F.col("id").alias("raw_post_id")), "raw_post_id", "left_semi")
    cleaned_keys = own.unionByName(by_raw.select("id", "batch_id"))
    with_cleaned = enriched.join(
        cleaned_keys.select(F.col("id").alias("cleaned_post_id"), "batch_id"),
        ["cleaned_post_id", "batch_id"],
        "left_semi",
    )
    stages = {"raw": raw_keys, "cleaned": cleaned_keys, "enriched": with_cleaned.select("id", "batch_id")}
    parts = [df.select(F.lit(stage).alias("stage"), "id", "batch_id", gone.alias("own")) for stage, df in stages.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def remove_rows(spark: SparkSession, path: str, schema: T.StructType, keys: DataFrame) -> None:
    """Rewrite the batches that hold some of the rows, without these. An action, harmless twice."""
    changed = batches_of(read_posts(spark, path, schema), keys)
    left = changed.join(keys.select("id", "batch_id"), ["id", "batch_id"], "left_anti").select(*schema.names)
    # The names of the batches that end up empty: an overwrite cannot remove their last rows.
    emptied = keys.select("batch_id").distinct().join(left.select("batch_id").distinct(), "batch_id", "left_anti")
    names = [r.batch_id for r in emptied.collect()]
    overwrite_batches(left, path)
    for name in names:
        empty_batch(spark, path, schema, name)


def run_deletion(
    spark: SparkSession, raw_path: str, cleaned_path: str, enriched_path: str, batch_id: str
) -> dict:
    """Delete a batch; the numbers of its raw and cleaned posts that went. An action."""
    tables = {
        "enriched": (enriched_path, ENRICHED_POSTS),
        "cleaned": (cleaned_path, CLEANED_POSTS),
        "raw": (raw_path, RAW_POSTS),
    }
    for path, schema in tables.values():
        ensure_table(spark, path, schema)
    folder = raw_path.rstrip("/") + "_deletions"
    log = f"{folder}/log"

    def note(run: str, step: str) -> None:
        spark.createDataFrame([(batch_id, run, step)], LOG).coalesce(1).write.mode("append").parquet(log)

    spark.createDataFrame([], LOG).write.mode("append").parquet(log)
    # Some rows for each deletion of this one batch.
    rows = spark.read.schema(LOG).parquet(log).where(F.col("batch_id") == batch_id).collect()
    done: dict[str, set] = {}
    for r in rows:
        done.setdefault(r.run, set()).add(r.step)
    open_runs = [run for run, steps in done.items() if STEPS[-1] not in steps]
    run = open_runs[0] if open_runs else uuid.uuid4().hex
    path = f"{folder}/{run}"
    if not open_runs:
        found = [read_posts(spark, *tables[name]) for name in ("raw", "cleaned", "enriched")]
        keys_to_delete(*found, batch_id).write.parquet(path)
        note(run, "keys")
    keys = spark.read.schema(KEYS).parquet(path)
    for step in STEPS[1:]:
        if step not in done.get(run, ()):
            remove_rows(spark, *tables[step], keys.where(F.col("stage") == step))
            note(run, step)
    counts = keys.where("own").groupBy("stage").count().collect()
    went = {r.stage: r["count"] for r in counts}
    return {"raw_deleted": went.get("raw", 0), "cleaned_deleted": went.get("cleaned", 0)}
