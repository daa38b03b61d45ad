"""Joins of bucketed tables: the same rows as the plain joins, and no shuffle."""

import uuid

import pytest

from moodwell.operators.cleaning import uncleaned
from moodwell.operators.reports import joined_posts
from moodwell.operators.scoring import unanalyzed
from moodwell.plans.testviews import cleaned_posts, enriched_posts, raw_posts
from moodwell.sources import buckets


@pytest.fixture
def prefix(spark):
    """Names for tables, and no broadcasts, which would hide a shuffle."""
    name, setting = f"posts_{uuid.uuid4().hex}", "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    yield name
    spark.conf.set(setting, was)
    for table in spark.catalog.listTables(pattern=f"{name}*"):
        spark.sql(f"DROP TABLE {table.name}")


def views(spark, small):
    return [view(spark, small) for view in (raw_posts, cleaned_posts, enriched_posts)]


def in_place(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "SortMergeJoin" in plan and "Exchange" not in plan


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns or df.columns).collect()), key=str)


def test_joins_read_buckets_in_place(spark, small, prefix, tmp_path):
    raw, cleaned, enriched = views(spark, small)
    one = raw.select("batch_id").first()[0]
    for part in (raw.where(raw.batch_id == one), raw.where(raw.batch_id != one)):
        buckets.append_bucketed(part, prefix, "raw", 5, str(tmp_path))
    buckets.append_bucketed(cleaned, prefix, "cleaned", 5)
    buckets.append_bucketed(enriched, prefix, "enriched", 5)

    joined = buckets.joined_in_place(spark, prefix)
    assert in_place(joined)
    assert rows(joined) == rows(joined_posts(raw, cleaned, enriched))
    mine = buckets.joined_in_place(spark, prefix, one)
    ids = [r.raw_post_id for r in mine.collect()]
    assert ids == sorted(ids, reverse=True)
    assert rows(mine) == rows(joined_posts(raw, cleaned, enriched, one))

    left = buckets.uncleaned_in_place(spark, prefix)
    assert in_place(left) and rows(left, "id", "batch_id") == rows(uncleaned(raw, cleaned), "id", "batch_id")
    left = buckets.unanalyzed_in_place(spark, prefix, lang=None)
    want = unanalyzed(cleaned, enriched, lang=None)
    assert in_place(left) and rows(left, "raw_post_id", "batch_id") == rows(want, "raw_post_id", "batch_id")

    buckets.compact_bucketed(spark, prefix, "raw", f"{prefix}_new", 5)
    assert rows(spark.table(f"{prefix}_new_raw"), "id") == rows(raw, "id")


def test_what_is_found_in_another_batch_is_left_out(spark, small, prefix):
    raw, cleaned, enriched = (df.limit(40) for df in views(spark, small))
    moved = cleaned.withColumn("batch_id", cleaned.batch_id.substr(2, 100))
    for stage, df in zip(buckets.KEYS, (raw, moved, enriched)):
        buckets.append_bucketed(df, prefix, stage, 3)
    stored = [spark.table(f"{prefix}_{stage}") for stage in buckets.KEYS]
    assert rows(buckets.joined_in_place(spark, prefix)) == rows(joined_posts(*stored, same_ids=True))
    assert {r.cleaned_text for r in buckets.joined_in_place(spark, prefix).collect()} == {None}


def test_empty_tables(spark, small, prefix):
    for stage, df in zip(buckets.KEYS, views(spark, small)):
        buckets.append_bucketed(df.limit(0), prefix, stage, 3)
    assert buckets.joined_in_place(spark, prefix).count() == 0
    assert buckets.uncleaned_in_place(spark, prefix).count() == 0
