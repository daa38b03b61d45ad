"""Stored tables, runs over them and the stream, in folders of their own."""

import re
from datetime import datetime, timedelta, timezone
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from moodwell.functions.emotions import model_scorer
from moodwell.operators.batches import drop_batch
from moodwell.operators.cleaning import clean_posts, clean_stage, uncleaned
from moodwell.operators.scoring import enrich_stage
from moodwell.plans import flow
from moodwell.plans.testviews import raw_posts
from moodwell.schemas import CLEANED_POSTS, COMMENTS, ENRICHED_POSTS, RAW_POSTS
from moodwell.session import work_folder
from moodwell.sources import keys
from moodwell.sources.comments import read_comments_csv
from moodwell.sources.tables import (
    append_posts,
    empty_batch,
    ensure_table,
    export_csv,
    overwrite_batches,
    read_posts,
)
from moodwell.streaming import incremental
from moodwell.streaming.incremental import clean_and_score_stream, watch_raw_posts

MOMENT = datetime(2024, 5, 1)


def post(i, batch, text="some words about cats", keyword="cats"):
    return (i, batch, "web", keyword, text, MOMENT, "{}", MOMENT)


def frame(spark, rows):
    return spark.createDataFrame(rows, RAW_POSTS)


def test_append_overwrite_and_empty(spark, tmp_path):
    path = str(tmp_path / "raw")
    ensure_table(spark, path, RAW_POSTS)
    assert read_posts(spark, path, RAW_POSTS).count() == 0
    odd = "b/c: é%+x"
    assert append_posts(frame(spark, [post(1, "a"), post(2, odd), post(3, odd)]), path) == 3
    ensure_table(spark, path, RAW_POSTS)
    assert overwrite_batches(frame(spark, [post(9, "a")]), path, compact=True) == 1
    table = read_posts(spark, path, RAW_POSTS)
    assert {(r.id, r.batch_id) for r in table.collect()} == {(9, "a"), (2, odd), (3, odd)}
    assert empty_batch(spark, path, RAW_POSTS, odd) == 2
    assert empty_batch(spark, path, RAW_POSTS, "absent") == 0
    assert [r.id for r in read_posts(spark, path, RAW_POSTS).collect()] == [9]


def test_batch_filter_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "raw")
    append_posts(frame(spark, [post(1, "a"), post(2, "b")]), path)
    one = read_posts(spark, path, RAW_POSTS).where(F.col("batch_id") == "a")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan


def test_batch_filter_after_cleaning_still_prunes(spark, tmp_path):
    path = str(tmp_path / "raw")
    append_posts(frame(spark, [post(1, "a"), post(2, "b")]), path)
    cleaned = clean_posts(read_posts(spark, path, RAW_POSTS)).where("batch_id = 'a'")
    plan = cleaned.select("id", "status")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan
    assert "ReadSchema: struct<id:bigint,raw_text:string>" in plan


def test_csv(spark, tmp_path):
    rows = [("x", 1, 'a "quoted", text'), ("y", 2, "two\nlines"), ("z", 3, None)]
    df = spark.createDataFrame(rows, COMMENTS)
    export_csv(df, str(tmp_path / "c"))
    assert {tuple(r) for r in read_comments_csv(spark, str(tmp_path / "c")).collect()} == set(rows)


def test_work_folder_follows_the_session(spark):
    def session(master, **settings):
        return SimpleNamespace(conf=settings_of(settings), sparkContext=SimpleNamespace(master=master))

    def settings_of(settings):
        return SimpleNamespace(get=lambda key, default: settings.get("shared", default))

    assert work_folder(session("yarn", shared="hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")
    assert work_folder(spark, "x") != work_folder(spark, "x")
    with pytest.raises(ValueError):
        work_folder(session("yarn"), "x")


def test_runs(spark, tmp_path):
    raw, cleaned, enriched = (str(tmp_path / n) for n in ("raw", "cleaned", "enriched"))
    source = spark.createDataFrame(
        [("Cats", 1, "I am happy today"), ("cats", 2, "angry cats rage"), ("dogs", 3, "x")], COMMENTS
    )
    ok = flow.run_ingestion(source, raw, " Cats ", "0a1b2c3d", MOMENT)
    assert (ok["status"], ok["batch_id"], ok["records_inserted"]) == ("success", "cats-0a1b2c3d", 2)
    assert flow.run_ingestion(source, raw, "cows", "1", MOMENT)["status"] == "error"
    assert flow.run_ingestion(source, raw, "  ", "1", MOMENT)["records_inserted"] == 0

    with pytest.raises(ValueError):
        flow.run_cleaning(spark, raw, cleaned, "absent", MOMENT)
    done = flow.run_all(spark, raw, cleaned, enriched, "cats-0a1b2c3d", MOMENT)
    assert (done["total_processed"], done["processed"]) == (2, 2)
    again = flow.run_all(spark, raw, cleaned, enriched, "cats-0a1b2c3d", MOMENT)
    assert (again["total_processed"], again["processed"]) == (0, 0)
    anew = flow.run_cleaning(spark, raw, cleaned, "cats-0a1b2c3d", MOMENT, reclean=True)
    assert anew["total_processed"] == 2
    assert read_posts(spark, cleaned, CLEANED_POSTS).count() == 2
    scores = read_posts(spark, enriched, ENRICHED_POSTS).collect()
    assert sorted(r.emotion_label for r in scores) == ["anger", "joy"]
    anew = flow.run_all(spark, raw, cleaned, enriched, "cats-0a1b2c3d", MOMENT, reclean=True)
    assert (anew["total_processed"], anew["processed"], anew["failed"]) == (2, 2, 0)
    assert read_posts(spark, enriched, ENRICHED_POSTS).count() == 2
    with pytest.raises(ValueError):
        flow.run_analysis(spark, cleaned, enriched, "absent", MOMENT)

    append_posts(frame(spark, [post(7, "x", "a sad and lonely day"), post(8, "y")]), raw)
    rest = flow.run_all(spark, raw, cleaned, enriched, None, MOMENT)
    assert (rest["total_processed"], rest["processed"]) == (2, 2)


def test_keys_are_unique_and_the_same_in_every_run(spark, tmp_path):
    raw = str(tmp_path / "raw")
    append_posts(frame(spark, [post(40, "old")]), raw)
    rows = [("k", i, f"a cat {i}") for i in range(500)] + [("k", 7, "a second cat 7")]
    source = spark.createDataFrame(rows, COMMENTS)

    def ingest(df, suffix):
        return flow.run_ingestion(df, raw, "k", suffix, MOMENT)["records_inserted"]

    def keys(batch):
        posts = read_posts(spark, raw, RAW_POSTS).where(F.col("batch_id") == batch)
        return {r.id: r.raw_text for r in posts.collect()}

    assert ingest(source.repartition(7), "a") == 501
    first = keys("k-a")
    assert sorted(first) == list(range(41, 542))
    assert first[48] == "a cat 7" and first[49] == "a second cat 7"
    # Again, from other files; then with some of the rows lost, then moved to another batch.
    assert ingest(source.repartition(3), "a") == 0
    left = read_posts(spark, raw, RAW_POSTS).where("batch_id = 'k-a' AND id % 2 = 0")
    overwrite_batches(spark.createDataFrame(left.select(*RAW_POSTS.names).collect(), RAW_POSTS), raw)
    assert ingest(source, "a") == 251
    assert keys("k-a") == first
    assert flow.run_assignment(spark, raw, "second", "new") == 1
    assert ingest(source, "a") == 0
    # Another batch, and other posts for the same one, get ranges of their own.
    assert ingest(source, "b") == 501
    assert sorted(keys("k-b")) == list(range(542, 1043))
    assert ingest(source.where("comment_id < 3"), "a") == 3
    assert read_posts(spark, raw, RAW_POSTS).groupBy("id").count().where("count > 1").isEmpty()


@pytest.mark.parametrize("few, named", [(1000, 1000), (0, 1000), (1000, 0), (0, 0)])
def test_pick(spark, monkeypatch, few, named):
    monkeypatch.setattr(flow, "MAX_SENT_KEYS", few)
    monkeypatch.setattr(flow, "MAX_NAMED_BATCHES", named)
    posts = frame(spark, [post(1, "a"), post(2, "a"), post(1, "b")])
    wanted = spark.createDataFrame([(1, "a"), (9, "c")], "id bigint, batch_id string")
    picked = flow.pick(posts, wanted, "test")
    assert [(r.id, r.batch_id) for r in picked.collect()] == [(1, "a")]


def test_assignment_rewrites_only_changed_batches(spark, tmp_path):
    raw = str(tmp_path / "raw")
    append_posts(
        frame(spark, [post(1, "a"), post(2, "a", "dogs", "dogs"), post(3, "b"), post(4, "c", "d", "d")]),
        raw,
    )

    def files_of_c():
        table = read_posts(spark, raw, RAW_POSTS).where("batch_id = 'c'")
        return table.select("_metadata.file_path").distinct().collect()

    kept = files_of_c()
    assert flow.run_assignment(spark, raw, "cats", "new") == 2
    after = read_posts(spark, raw, RAW_POSTS)
    assert {(r.id, r.batch_id) for r in after.collect()} == {(1, "new"), (2, "a"), (3, "new"), (4, "c")}
    assert files_of_c() == kept
    assert flow.run_assignment(spark, raw, "cats", "new") == 2
    assert read_posts(spark, raw, RAW_POSTS).count() == 4
    with pytest.raises(ValueError):
        flow.run_assignment(spark, raw, "nothing like it", "new")


def test_two_batches_of_one_source_lose_nothing(spark, tmp_path):
    raw, cleaned, enriched = (str(tmp_path / n) for n in ("raw", "cleaned", "enriched"))
    happy = "a happy cat"
    one = [("k", 1, happy), ("k", 2, happy), ("k", 3, "a sad cat")]
    two = [("k", 1, "another cat"), ("k", 2, happy)]
    for rows, suffix in ((one, "a"), (two, "b")):
        flow.run_ingestion(spark.createDataFrame(rows, COMMENTS), raw, "k", suffix, MOMENT)
    assert flow.run_assignment(spark, raw, "happy", "new") == 3
    posts = read_posts(spark, raw, RAW_POSTS)
    assert sorted((r.batch_id, r.raw_text) for r in posts.collect()) == [
        ("k-a", "a sad cat"), ("k-b", "another cat"), *[("new", happy)] * 3,
    ]
    assert posts.select("id").distinct().count() == 5
    assert flow.run_all(spark, raw, cleaned, enriched, "k-a", MOMENT)["processed"] == 1
    tables = [read_posts(spark, p, t) for p, t in ((raw, RAW_POSTS), (cleaned, CLEANED_POSTS))]
    assert uncleaned(*tables, "k-b").count() == 1
    assert flow.run_all(spark, raw, cleaned, enriched, "k-b", MOMENT)["processed"] == 1
    scores = read_posts(spark, enriched, ENRICHED_POSTS)
    texts = read_posts(spark, cleaned, CLEANED_POSTS)
    left = drop_batch(read_posts(spark, raw, RAW_POSTS), texts, scores, "k-a")
    assert [df.count() for df in left[:3]] == [4, 1, 1]


def test_many_posts_move_at_once(spark, tmp_path):
    raw = str(tmp_path / "raw")
    append_posts(frame(spark, [post(i, "ab"[i % 2]) for i in range(10_000)]), raw)
    assert flow.run_assignment(spark, raw, "cats", "new", limit=9_999) == 9_999
    assert read_posts(spark, raw, RAW_POSTS).groupBy("batch_id").count().count() == 2


def test_failed_scores_are_counted_and_tried_again(spark, tmp_path):
    raw, cleaned, enriched = (str(tmp_path / n) for n in ("raw", "cleaned", "enriched"))
    append_posts(frame(spark, [post(i, "a") for i in range(5)]), raw)

    def failing():
        def score(texts):
            raise RuntimeError("no scores today")

        return score

    run = flow.run_all(spark, raw, cleaned, enriched, "a", MOMENT, scorer=model_scorer(failing))
    assert (run["total_processed"], run["processed"], run["failed"]) == (5, 0, 5)
    run = flow.run_all(spark, raw, cleaned, enriched, "a", MOMENT)
    assert (run["total_processed"], run["processed"], run["failed"]) == (0, 5, 0)


def test_model_is_loaded_once_per_worker(spark, tmp_path):
    loads = str(tmp_path)

    def load():
        import os
        import uuid

        open(os.path.join(loads, f"{os.getpid()}-{uuid.uuid4().hex}"), "w").close()
        return lambda texts: [[{"label": "joy", "score": 1.0}] for _ in texts]

    posts = spark.range(200).repartition(40).select(F.col("id").cast("string").alias("t"))
    posts.select(model_scorer(load)(F.col("t"))).write.format("noop").mode("overwrite").save()
    workers = [path.name.split("-")[0] for path in tmp_path.iterdir()]
    assert 1 <= len(workers) == len(set(workers)) < 40


def test_stream_equals_batch_and_survives_replay(spark, small, tmp_path):
    raw, cleaned, enriched = (str(tmp_path / n) for n in ("raw", "cleaned", "enriched"))
    posts = raw_posts(spark, small)
    first, second = posts.where("id < 120"), posts.where("id >= 120")

    def run(checkpoint):
        stream = watch_raw_posts(spark, raw, max_files=50)
        clean_and_score_stream(stream, cleaned, enriched, str(tmp_path / checkpoint)).awaitTermination()

    append_posts(first.repartition(4), raw)
    run("one")
    append_posts(second.repartition(2), raw)
    run("one")

    def state():
        texts = read_posts(spark, cleaned, CLEANED_POSTS)
        scores = read_posts(spark, enriched, ENRICHED_POSTS)
        return (
            sorted((r.id, r.batch_id, r.cleaned_text, r.status) for r in texts.collect()),
            sorted((r.id, r.batch_id, r.emotion_label, r.confidence) for r in scores.collect()),
        )

    moment = F.lit(MOMENT)
    batch = clean_stage(posts, None, moment)
    nothing = spark.createDataFrame([], ENRICHED_POSTS)
    scored = enrich_stage(batch, nothing, moment)
    want = (
        sorted((r.id, r.batch_id, r.cleaned_text, r.status) for r in batch.collect()),
        sorted((r.id, r.batch_id, r.emotion_label, r.confidence) for r in scored.collect()),
    )
    assert state() == want
    # A new checkpoint reads every file again: nothing may be added.
    run("two")
    assert state() == want


def test_stream_moves_what_it_needs_and_writes_few_files(spark, tmp_path, capsys):
    raw, cleaned, enriched = (str(tmp_path / n) for n in ("raw", "cleaned", "enriched"))
    append_posts(frame(spark, [post(i, "a", f"a happy cat {i}") for i in range(400)]), raw)
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", 3 * cores)
    try:
        stream = clean_and_score_stream(watch_raw_posts(spark, raw), cleaned, enriched, str(tmp_path / "c"))
        stream.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
    stream.explain()
    plan = capsys.readouterr().out
    assert "raw_text" in plan and "raw_json" not in plan and "keyword" not in plan
    scores = read_posts(spark, enriched, ENRICHED_POSTS)
    assert sorted(r.id for r in scores.collect()) == list(range(400))
    assert len(list((tmp_path / "enriched").rglob("*.parquet"))) <= cores + cores  # with those of the empty table


def test_stream_reads_tables_for_old_posts_only(spark, tmp_path, monkeypatch):
    raw, cleaned, enriched = (str(tmp_path / n) for n in ("raw", "cleaned", "enriched"))
    monkeypatch.setattr(incremental, "CLOCKS", timedelta(0))
    now = datetime.now(timezone.utc).replace(tzinfo=None)

    def fresh(*ids):
        rows = [(*post(i, "a", "a happy cat")[:7], now) for i in ids]
        append_posts(frame(spark, rows), raw)

    def start():
        return clean_and_score_stream(
            watch_raw_posts(spark, raw), cleaned, enriched, str(tmp_path / "c"), every="1 second"
        )

    def ids():
        return sorted(r.id for r in read_posts(spark, enriched, ENRICHED_POSTS).select("id").collect())

    fresh(1, 2)
    stream = start()
    try:
        stream.processAllAvailable()
        assert ids() == [1, 2]
        # No reader gets past this file, and none has to.
        broken = [tmp_path / n / "batch_id=a" / "part-broken.parquet" for n in ("cleaned", "enriched")]
        for path in broken:
            path.write_bytes(b"PAR1 no table PAR1")
        fresh(3)
        stream.processAllAvailable()
        # Known from the state: these came before.
        fresh(1, 3, 4)
        stream.processAllAvailable()
    finally:
        stream.stop()
    for path in broken:
        path.write_bytes(b"")
        path.unlink()
    assert ids() == [1, 2, 3, 4]
    # Fetched long ago: looked up, though the files are new.
    stream = start()
    try:
        append_posts(frame(spark, [post(1, "b", "a happy cat"), post(5, "b", "a happy cat")]), raw)
        stream.processAllAvailable()
    finally:
        stream.stop()
    assert ids() == [1, 2, 3, 4, 5]
    texts = read_posts(spark, cleaned, CLEANED_POSTS)
    assert sorted(r.id for r in texts.collect()) == [1, 2, 3, 4, 5]


def test_stream_takes_up_what_a_stopped_run_left(spark, tmp_path):
    """A run that stopped between its two tables: the texts are there, the scores are not."""
    raw, cleaned, enriched = (str(tmp_path / n) for n in ("raw", "cleaned", "enriched"))
    append_posts(frame(spark, [post(i, "a", "a happy cat") for i in range(6)]), raw)

    def failing(text):
        return F.raise_error(F.lit("stopped")).cast("array<struct<label:string,score:double>>")

    def run(scorer=None):
        stream = watch_raw_posts(spark, raw)
        clean_and_score_stream(stream, cleaned, enriched, str(tmp_path / "c"), scorer=scorer).awaitTermination()

    with pytest.raises(Exception, match="stopped"):
        run(failing)
    assert read_posts(spark, cleaned, CLEANED_POSTS).count() == 6
    run()
    assert read_posts(spark, cleaned, CLEANED_POSTS).count() == 6
    assert read_posts(spark, enriched, ENRICHED_POSTS).count() == 6


def test_stream_goes_on(spark, tmp_path):
    raw, cleaned, enriched = (str(tmp_path / n) for n in ("raw", "cleaned", "enriched"))
    append_posts(frame(spark, [post(1, "a")]), raw)
    stream = clean_and_score_stream(
        watch_raw_posts(spark, raw), cleaned, enriched, str(tmp_path / "c"), every="1 second"
    )
    try:
        stream.processAllAvailable()
        append_posts(frame(spark, [post(2, "a"), post(3, "b")]), raw)
        stream.processAllAvailable()
    finally:
        stream.stop()
    assert sorted(r.id for r in read_posts(spark, enriched, ENRICHED_POSTS).collect()) == [1, 2, 3]


def test_numbers_follow_whole_texts_while_ranges_come_from_their_beginnings(spark, monkeypatch):
    """What Spark sends to the driver to find ranges holds no whole text."""
    kind = type(spark.range(0))
    ranged, plans = kind.repartitionByRange, []

    def noted(self, *args):
        out = ranged(self, *args)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    monkeypatch.setattr(kind, "repartitionByRange", noted)
    rows = [(i, t) for i in (3, None, 1) for t in ("same beginning of a text " * 40 + x for x in "cab")]
    rows += [(1, None), (1, "same"), (1, "é" * 30), (None, None)]
    df = spark.createDataFrame(rows, "id long, raw_text string").repartition(5)
    found = keys.numbered(df, "id", "raw_text")
    got = [(r.id, r.raw_text) for r in found.orderBy("number").collect()]
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    assert got == ordered
    assert sorted(r.number for r in found.collect()) == list(range(len(rows)))
    order = re.search(r"RepartitionByExpression \[(.*?)\]", plans[0]).group(1)
    assert re.search(r"left\(raw_text#\d+, 16\)|substring\(raw_text", order), order
    assert not re.search(r"(?<!\()raw_text#\d+ ASC", order)
