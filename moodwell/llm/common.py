"""Helpers that several operators share: words, written tables, sides of a checked size."""

from __future__ import annotations

import sys
from collections.abc import Callable, Hashable
from string import ascii_lowercase
from types import ModuleType

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwell.session import work_folder

#: Characters between words, after A to Z have been lower-cased: ASCII but for letters and
#: digits. Listed one by one, since Java looks those up in a table and tests ranges in turn.
SEPARATORS = "[%s]+" % "".join(f"\\x{c:02x}" for c in range(128) if not chr(c).isalnum())
#: A side with at most so many rows of fixed width may be sent to every task.
SENT_ROWS = 200_000
#: Bits per key of a table that tells which rows may have one, and most bits that are sent (64 MB).
BITS_PER_KEY = 16
MOST_BITS = 1 << 29
PART_BITS = 1 << 15  # what one row of that table holds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe if executors are lost."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sent_if_small(side: DataFrame, rows: int = SENT_ROWS) -> DataFrame:
    """``side``, a written table, for a broadcast if its rows are counted to be few, else as it is."""
    return F.broadcast(side) if side.limit(rows + 1).count() <= rows else side


def likely_among(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """All rows of ``df`` whose ``column`` is among ``keys``, a written table of distinct ones, and
    a few others: about one in 16, more if there are so many keys that the table of bits is full.
    No row of ``df`` is moved; what is sent to tasks has a set greatest size."""
    bits = min(MOST_BITS, max(PART_BITS, BITS_PER_KEY * keys.count()))
    place = F.pmod(F.xxhash64(column), F.lit(bits))
    part, bit = F.floor(place / PART_BITS).alias("_part"), F.pmod(place, F.lit(PART_BITS)).alias("_bit")
    # Dealt first, so that a part is put together in one task, not a share of it in each.
    dealt = keys.select(part, bit).repartition("_part")
    parts = dealt.groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    asked = df.withColumn("_part", part).withColumn("_bit", bit.cast("int"))
    byte = F.conv(F.hex(F.substring("_bits", F.expr("_bit DIV 8 + 1"), F.lit(1))), 16, 10).cast("int")
    found = asked.join(F.broadcast(parts), "_part").where(F.getbit(byte, F.expr("_bit % 8")) == 1)
    return found.select(df.columns)


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, all else as it is; ``lower`` does so where all is ASCII, and faster."""
    other = text
    for c in ascii_lowercase:  # some times faster than translate, which works on characters
        other = F.replace(other, F.lit(c.upper()), F.lit(c))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(other)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it stands in the result."""
    return F.get(F.transform(F.array(value), use), 0)


def words_of(text: Column) -> Column:
    """The words of a text: letters, digits and everything beyond ASCII; none for null."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.array_remove(parts, "")


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; null and the empty text differ."""
    return F.unhex(F.md5(F.coalesce(F.concat(F.lit("t"), text), F.lit(""))))


def once_per_process(key: Hashable, make: Callable):
    """What ``make`` gives, made once in a Python worker and kept for its later tasks.

    Keys of one kind begin alike (a text is one by itself). A worker serves the steps of a job in
    turn, so that what it holds of another kind goes.
    """
    held = sys.modules.setdefault("_moodwell_held", ModuleType("_moodwell_held")).__dict__
    if key not in held:
        let_go_but(key[0] if isinstance(key, tuple) else key)
        held[key] = make()
    return held[key]


def let_go_but(kind: Hashable) -> None:
    """Drop what ``once_per_process`` holds in this worker of any other kind: for steps that keep nothing."""
    held = sys.modules.setdefault("_moodwell_held", ModuleType("_moodwell_held")).__dict__
    others = [k for k in held if isinstance(k, tuple) and k[0] != kind]
    for other in others:
        del held[other]
    if others:
        pa.default_memory_pool().release_unused()
