"""Deletion of stored batches, stopped at every step and taken up again."""

import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from moodwell.operators.batches import drop_batch
from moodwell.plans import deletion, flow
from moodwell.plans.deletion import run_deletion
from moodwell.schemas import CLEANED_POSTS, COMMENTS, ENRICHED_POSTS, RAW_POSTS
from moodwell.sources.tables import read_posts

MOMENT = datetime(2024, 5, 1)
SCHEMAS = [RAW_POSTS, CLEANED_POSTS, ENRICHED_POSTS]


NAMES = ["raw", "cleaned", "enriched"]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Two batches, and a post that moved to a third one after it was scored."""
    folder = tmp_path_factory.mktemp("tables")
    paths = [str(folder / name) for name in NAMES]
    for keyword, texts in {"cats": ["a happy cat", "a sad cat", "an old cat"], "dogs": ["a glad dog", "a dog"]}.items():
        source = spark.createDataFrame([(keyword, i, t) for i, t in enumerate(texts)], COMMENTS)
        flow.run_ingestion(source, paths[0], keyword, "1", MOMENT)
    flow.run_all(spark, *paths, None, MOMENT)
    flow.run_assignment(spark, paths[0], "old cat", "moved")
    return folder


@pytest.fixture
def paths(made, tmp_path):
    shutil.copytree(made, tmp_path / "copy")
    return [str(tmp_path / "copy" / name) for name in NAMES]


def rows_of(frames):
    return [sorted(map(str, df.select("id", "batch_id").collect())) for df in frames]


def held(spark, paths):
    return [read_posts(spark, path, schema) for path, schema in zip(paths, SCHEMAS)]


@pytest.mark.parametrize("batch", ["cats-1", "moved", "absent"])
def test_all_that_belongs_to_a_batch_goes(spark, paths, batch):
    *left, counts = drop_batch(*held(spark, paths), batch)
    want, (raw_gone, cleaned_gone) = rows_of(left), counts.first()
    done = run_deletion(spark, *paths, batch)
    assert rows_of(held(spark, paths)) == want
    assert done == {"raw_deleted": raw_gone, "cleaned_deleted": cleaned_gone}
    assert run_deletion(spark, *paths, batch) == {"raw_deleted": 0, "cleaned_deleted": 0}
    assert rows_of(held(spark, paths)) == want


@pytest.mark.parametrize("stop", [0, 1, 2, 4, 5, 6])
def test_a_stopped_run_is_taken_up(spark, paths, monkeypatch, stop):
    want = rows_of(drop_batch(*held(spark, paths), "cats-1")[:3])
    calls = 0

    def stopping(work):
        def run(*args):
            nonlocal calls
            calls += 1
            if calls == stop + 1:
                raise RuntimeError("stopped")
            return work(*args)

        return run

    with monkeypatch.context() as patch:
        for name in ("overwrite_batches", "empty_batch"):
            patch.setattr(deletion, name, stopping(getattr(deletion, name)))
        if stop < 6:
            with pytest.raises(RuntimeError):
                run_deletion(spark, *paths, "cats-1")
        else:
            run_deletion(spark, *paths, "cats-1")
    done = run_deletion(spark, *paths, "cats-1")
    assert rows_of(held(spark, paths)) == want
    assert done["raw_deleted"] == (2 if stop < 6 else 0)


def test_all_scores_go_at_once(spark, paths):
    assert flow.drop_scores(spark, paths[2], None) == 5
    assert read_posts(spark, paths[2], ENRICHED_POSTS).where(F.col("id") > 0).isEmpty()
    assert flow.run_all(spark, *paths, None, MOMENT)["processed"] == 5
