"""CSV read in parts against Spark's reader of whole files."""

import random

import pytest
from pyspark.sql import functions as F

from moodwell.schemas import COMMENTS
from moodwell.sources import records
from moodwell.sources.comments import read_comments_csv


def whole(spark, path):
    reader = spark.read.schema(COMMENTS).option("header", True).option("multiLine", True)
    return reader.option("quote", '"').option("escape", '"').csv(path)


def field(rng):
    sign = lambda: rng.choice(["a", "é", " ", ",", '"', "\n", "😀", "word"])
    return "".join(sign() for _ in range(rng.randint(0, rng.choice([3, 12, 60]))))


def written(value, rng):
    if any(c in value for c in ',"\n') or not value or rng.random() < 0.3:
        return '"' + value.replace('"', '""') + '"'
    return value


@pytest.fixture
def split(spark):
    """Files in blocks of some bytes."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(name) for name in names]

    def cut(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 1)

    yield cut
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("size, sent", [(40, 10**6), (257, 10**6), (10**7, 10**6), (100, 0)])
def test_blocks_equal_whole_files(spark, tmp_path, split, monkeypatch, size, sent):
    monkeypatch.setattr(records, "SENT_BLOCKS", sent)
    rng = random.Random(size)
    want = []
    for file in range(3):
        lines = ['device,comment_id,"comment\nin words"']
        for i in range(60):
            device, text = field(rng), field(rng)
            want.append((device, file * 100 + i, text))
            lines.append(f"{written(device, rng)},{file * 100 + i},{written(text, rng)}")
        end = rng.choice(["", "\n"])
        (tmp_path / f"{file}.csv").write_bytes(("\n".join(lines) + end).encode())
    expected = rows_of(whole(spark, str(tmp_path)))
    assert sorted((i, d or "", t or "") for d, i, t in expected) == sorted((i, d, t) for d, i, t in want)
    split(size)
    found = read_comments_csv(spark, str(tmp_path))
    assert rows_of(found) == expected


def test_odd_files(spark, tmp_path, split):
    """Quotes inside unquoted fields, empty and short records, two line endings, nothing at all."""
    texts = [
        'h,h,h\nx,1,5" wide\ny,2,say "hi", you\nz,3,"a ""b"" c"\n\n\nw,4\nv,5,""\nu,6,\n,,\n',
        'h,h,h\r\nx,7,"two\r\nlines"\r\ny,8,plain\r\n',
        'h,h,h\nx,1,"one\r\nb"\ny,2,"b\rc"\n',
        "h,h,h\n",
        "",
        'h,h,h\nx,9,"never closed\nand, more\nto,10,come',
    ]
    for size in (16, 10**6):
        for k, text in enumerate(texts):
            path = tmp_path / f"{size}-{k}.csv"
            path.write_bytes(text.encode())
            expected = rows_of(whole(spark, str(path)))
            split(size)
            assert rows_of(read_comments_csv(spark, str(path))) == expected, text


def test_one_file_in_several_tasks(spark, tmp_path, split):
    rows = spark.range(2000).select(
        F.lit("k").alias("device"), F.col("id").alias("comment_id"), F.repeat(F.lit('a "b"\n'), 20).alias("comment")
    )
    lines = [f'k,{r.comment_id},"{r.comment.replace(chr(34), chr(34) * 2)}"' for r in rows.collect()]
    (tmp_path / "one.csv").write_text("device,comment_id,comment\n" + "\n".join(lines))
    split(20_000)
    found = read_comments_csv(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() > 10
    assert rows_of(found) == rows_of(rows)
    # Whole records stay where they are read: only parts of records are grouped.
    plan = read_comments_csv(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan text") == 1
