"""Relational operators on small tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from moodwell.functions.ids import ingest_batch_id, search_batch_id
from moodwell.functions.moments import moment
from moodwell.operators import batches, explorer, ingest, progress, reports

RAW = "id long, batch_id string, platform string, keyword string, raw_text string, created_at timestamp_ntz"
CLEANED = "id long, raw_post_id long, batch_id string, cleaned_text string, language string"
ENRICHED = (
    "id long, cleaned_post_id long, batch_id string, emotion_label string, "
    "confidence decimal(3,2), analyzed_at timestamp_ntz"
)


@pytest.fixture(scope="module")
def tables(spark):
    day = lambda n: datetime(2024, 1, n)
    raw = [
        (1, "a", "x", "cats", "I like CATS", day(1)),
        (2, "a", "x", None, "dogs only", day(3)),
        (3, "a", "x", "dogs", "100% cats", None),
        (4, "b", "y", "Cats", "none", day(3)),
        (5, "c", "y", "cows", "a_b", day(2)),
    ]
    cleaned = [
        (1, 1, "a", "I like CATS", "en"),
        (2, 2, "a", "dogs only", "en"),
        (4, 4, "b", "none", "fr"),
        (9, 9, "gone", "old", "en"),
    ]
    enriched = [
        (1, 1, "a", "Joy", "0.90", day(5)),
        (4, 4, "b", "", "0.30", day(6)),
        (9, 9, "gone", "fear", "0.50", day(7)),
    ]
    from decimal import Decimal

    enriched = [(*r[:4], Decimal(r[4]), r[5]) for r in enriched]
    return (
        spark.createDataFrame(raw, RAW),
        spark.createDataFrame(cleaned, CLEANED),
        spark.createDataFrame(enriched, ENRICHED),
    )


def ids(df, name="id"):
    return [r[name] for r in df.collect()]


def test_batch_ids(spark):
    row = spark.range(1).select(
        ingest_batch_id(F.lit("  Samsung S26 "), F.lit("0a1b2c3d")),
        search_batch_id(F.lit(" Climate & Change! "), F.lit("17")),
        search_batch_id(F.lit("!!!"), F.lit("17")),
    ).first()
    assert list(row) == ["samsung_s26-0a1b2c3d", "frontend-climate-change-17", "frontend-batch-17"]


def test_moment_does_not_move_with_the_session(spark):
    from datetime import timedelta, timezone

    noon = datetime(2024, 5, 1, 12)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        east = noon.replace(tzinfo=timezone(timedelta(hours=2)))
        row = spark.range(1).select(moment(noon), moment(east)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert list(row) == [noon, datetime(2024, 5, 1, 10)]


def test_match_comments(spark):
    source = spark.createDataFrame(
        [(1, " IPHONE 17 ", " good "), (2, "iPhone 17", ""), (3, None, "x"), (4, "iphone 17", None),
         (5, "iphone 17", "  "), (6, "iphone 1x", "other")],
        "comment_id long, device string, comment string",
    )
    found = ingest.match_comments(source, " iPhone 17 ").orderBy("id").collect()
    assert [(r.id, r.comment) for r in found] == [(1, "good"), (5, "")]
    assert ids(ingest.match_comments(source, "iphone 17", limit=1)) == [1]
    assert ids(ingest.match_comments(source, "iphone 17", limit=0)) == []
    like = ingest.match_comments(source, "iphone 1_", mode="ilike").orderBy("id")
    assert [(r.id, r.comment) for r in like.collect()] == [(2, ""), (5, ""), (6, "other")]
    with pytest.raises(ValueError):
        ingest.match_comments(source, "  ")
    with pytest.raises(ValueError):
        ingest.match_comments(source, "x", mode="fuzzy")


def test_raw_json_defaults(spark):
    df = spark.createDataFrame([(1, None, 5)], "id int, emotion string, upvotes int")
    row = ingest.with_raw_json(df).first()
    assert (row.platform, row.keyword) == ("reddit", "")
    assert row.raw_json == '{"upvotes":5,"emotion":"neutral","characteristic":"standard"}'


def test_simple_clean_removes_first_emoji_only(spark):
    df = spark.createDataFrame([("Wow 😊\n 😊 End",), ("a ❤️ b",), ("None",)], "t string")
    got = [r[0] for r in df.select(ingest.simple_clean(F.col("t"))).collect()]
    assert got == ["wow 😊 end", "a ️ b", "none"]


def test_search_and_topk(tables):
    raw, _, _ = tables
    assert sorted(ids(batches.search_posts(raw, "cat"))) == [1, 3, 4]
    assert sorted(ids(batches.search_posts(raw, "a_b"))) == [5]
    assert sorted(ids(batches.search_posts(raw, "c_w"))) == [5]
    assert ids(batches.newest(raw, 3)) == [3, 4, 2]
    plan = batches.newest(raw, 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    for limit in (0, -1):
        with pytest.raises(ValueError):
            batches.newest(raw, limit)


def test_assignment(tables):
    raw, _, _ = tables
    matched = batches.newest(batches.search_posts(raw, "cat"), 2)
    after = batches.assign_batch(raw, matched, "new")
    assert {r.id: r.batch_id for r in after.collect()} == {1: "a", 2: "a", 3: "new", 4: "new", 5: "c"}
    assert after.columns == raw.columns
    assert ids(batches.assignment_preview(matched)) == [3, 4]


def test_drop_batch_cascades(tables):
    raw, cleaned, enriched, counts = batches.drop_batch(*tables, "a")
    assert sorted(ids(raw)) == [4, 5]
    assert sorted(ids(cleaned)) == [4, 9]
    assert sorted(ids(enriched)) == [4, 9]
    assert tuple(counts.first()) == (3, 2)
    nothing = batches.drop_batch(*tables, "absent")
    assert tuple(nothing[3].first()) == (0, 0) and nothing[2].count() == 3


def test_progress(tables):
    raw, cleaned, enriched = tables
    got = {r.batch_id: r for r in progress.cleaning_stats(raw, cleaned).collect()}
    assert tuple(got["a"])[1:] == (3, 2, 1, 66.7)
    assert tuple(got["gone"])[1:] == (0, 1, -1, None)
    one = progress.analysis_stats(cleaned, enriched, "a").collect()
    assert [tuple(r) for r in one] == [("a", 2, 1, 1)]
    assert tuple(progress.fleet_status(cleaned, enriched).first()) == (3, 1)
    assert {tuple(r) for r in progress.unanalyzed_by_batch(cleaned, enriched).collect()} == {("a", 1)}


def test_joined_posts(tables):
    one = reports.joined_posts(*tables, batch_id="a").collect()
    assert [(r.raw_post_id, r.cleaned_text, r.emotion_label) for r in one] == [
        (3, None, None),
        (2, "dogs only", None),
        (1, "I like CATS", "Joy"),
    ]
    assert reports.joined_posts(*tables).count() == 5


def test_joins_by_the_same_ids_shuffle_each_table_once(spark, tables):
    plain, same = reports.joined_posts(*tables), reports.joined_posts(*tables, same_ids=True)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, same.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffles = [
            df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
            for df in (reports.joined_posts(*tables), reports.joined_posts(*tables, same_ids=True))
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffles == [4, 3]


def test_join_repeats_posts_cleaned_twice(tables):
    raw, cleaned, enriched = tables
    twice = cleaned.unionByName(cleaned.withColumn("id", F.col("id") + 100))
    assert reports.joined_posts(raw, twice, enriched, "a").count() == 5


def test_counts(tables):
    rows = reports.joined_posts(*tables)
    hero = {r.batch_id: tuple(r)[1:] for r in reports.hero_counts(rows).collect()}
    assert hero == {"a": (3, 1, 2), "b": (1, 0, 1), "c": (1, 0, 1)}
    spread = reports.emotion_distribution(rows).where("batch_id = 'a'").orderBy("position").collect()
    assert [(r.emotion, r.posts) for r in spread][:2] == [("Joy", 1), ("Anger", 0)] and len(spread) == 7
    share = reports.emotion_share(rows).where("emotion = 'Joy'").collect()
    assert {r.batch_id: r.percent for r in share} == {"a": 100.0, "b": 0.0, "c": 0.0}


def test_reports(tables):
    raw, cleaned, enriched = tables
    assert [tuple(r) for r in reports.posts_per_batch(raw).collect()] == [("a", 3), ("b", 1), ("c", 1)]
    assert tuple(reports.distinct_counts(raw).first()) == (3, 2, 4)
    report = reports.batch_count_report(raw, {"a": "A", "zz": "Z"}).collect()
    assert [tuple(r) for r in report] == [("Total Raw Posts", 5), ("A", 3), ("Z", 0)]
    counts = reports.table_counts({"raw": raw, "enriched": enriched}).collect()
    assert {tuple(r) for r in counts} == {("raw", 5), ("enriched", 3)}
    top = reports.confidence_by_emotion(enriched).first()
    assert (top.emotion_label, top.avg_confidence) == ("Joy", 0.9)
    assert reports.emotion_percentage(enriched, "a").first().percentage == 100.0
    assert reports.batch_results(enriched, "a").first().total_results == 1
    assert ids(reports.sample_posts(raw, "raw_text", 2)) == [1, 2]
    assert ids(batches.raw_posts_by_batch(raw, "a")) == [1, 2, 3]
    assert [r.posts for r in reports.emotion_by_batch(enriched).collect()] == [1, 1, 1]


def test_json_field(spark):
    df = spark.createDataFrame([('{"upvotes": 7}',), ('{"upvotes": "x"}',), ("{}",), ("no",), (None,)], "j string")
    assert [r.upvotes for r in reports.json_field(df, "j", "upvotes").collect()] == [7, None, None, None, None]


def test_explorer(spark, tables):
    rows = reports.joined_posts(*tables)
    find = lambda **k: sorted(ids(explorer.explore(rows, **k), "raw_post_id"))
    assert find(text=" CATS|cows ") == [1, 3]
    assert find(text="100%", literal=True) == [3]
    assert find(text="") == [1, 2, 3, 4, 5]
    assert find(text="  ") == [1, 2, 3, 4, 5]
    assert find(emotion="joy") == [1]
    assert find(min_confidence=0.3) == [1, 4]
    written = rows.withColumn("confidence", F.lit("n/a"))
    assert explorer.explore(written).select("confidence").distinct().first()[0] == 0.0
    shown = {r.raw_post_id: r for r in explorer.display(explorer.explore(rows)).collect()}
    assert (shown[1].emotion, shown[1].confidence_pct) == ("joy", 90.0)
    assert (shown[4].emotion, shown[2].emotion, shown[2].keyword) == ("pending", "pending", "")
    counts = explorer.shown_counts(rows, explorer.explore(rows, emotion="joy")).first()
    assert (counts.total, counts.shown) == (5, 1)
    assert ids(explorer.newest_first(rows), "raw_post_id") == [5, 4, 3, 2, 1]


def test_shorten(spark):
    texts = [("  short ",), ("x" * 10,), ("x" * 6 + " " + "y" * 9,), (None,)]
    df = spark.createDataFrame(texts, "t string")
    got = [r[0] for r in df.select(explorer.shorten(F.col("t"), 10)).collect()]
    assert got == ["short", "x" * 10, "xxxxxx...", ""]
