"""Sharding by sampled splitters.

Records are in order of a hash of their text, then of their id. A size-weighted sample
of the hashes gives quantile boundaries of many small ranges; ranges that
turn out overfull, since one text has many copies, are subdivided by the id's hash. The exact
size before each range and before each record in it then say which shard a record goes
to: no shard is off the mean by more than one record at either end.

Defined results: a null text has size 1 and counts as empty in its checksum; equal and
repeated rows are kept, each with a slot of its own; null ids are ordinary ids; an empty
table gives an empty result; other columns are not read. Only keys and sizes travel, no text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodwell.llm.common import written

#: Small ranges to cut the records into, and sampled hashes for each of them.
RANGES = 1024
SAMPLES_PER_RANGE = 16


def splitters(keyed: DataFrame, ranges: int, samples: int, seed: int = 7) -> np.ndarray:
    """Boundaries from a sample in which a record's chance follows its size.

    At most ``samples`` hashes reach the driver.
    """
    arrival = (-F.log(1 - F.rand(seed)) / F.col("size")).alias("arrival")
    drawn = keyed.select("text_hash", arrival).orderBy("arrival", "text_hash").limit(samples)
    hashes = np.sort(np.array([r.text_hash for r in drawn.collect()], dtype=np.int64))
    if not len(hashes):
        return hashes
    return np.unique(hashes[np.arange(1, ranges) * len(hashes) // ranges])


def assign_shards(
    df: DataFrame,
    shards: int = 16,
    id_column: str = "doc_id",
    text_column: str = "text",
    ranges: int = RANGES,
) -> DataFrame:
    """``id, size, text_crc32, shard, slot`` of every row. Runs jobs at once."""
    spark = df.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    size = F.octet_length(text).cast("long") + 1
    # The row number tells apart what is equal in everything else; written, it stays.
    keyed = written(
        df.select(
            F.col(id_column).alias("id"),
            size.alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("text_hash"),
            F.xxhash64(F.col(id_column), F.monotonically_increasing_id()).alias("id_hash"),
        ),
        "shard-keys",
    )
    bounds = splitters(keyed, ranges, ranges * SAMPLES_PER_RANGE)

    @F.pandas_udf("int")
    def range_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for hashes in batches:
            yield pd.Series(np.searchsorted(bounds, hashes.to_numpy(), side="right"))

    ranged = keyed.withColumn("range", range_of("text_hash"))
    # One row for each of a fixed number of ranges.
    filled = ranged.groupBy("range").agg(F.sum("size").alias("bytes")).orderBy("range").collect()
    total = sum(r.bytes for r in filled)
    pieces = np.ones(len(bounds) + 1, dtype=np.int64)
    for r in filled:
        if r.bytes * ranges > 2 * total:
            pieces[r.range] = -(-r.bytes * ranges // total)
    before = np.concatenate([[0], np.cumsum(pieces)[:-1]])

    @F.pandas_udf("int")
    def piece_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for found, hashes in batches:
            at = found.to_numpy()
            share = (hashes.to_numpy() >> 32).astype(np.int64) + (1 << 31)
            yield pd.Series(before[at] + (share * pieces[at] >> 32))

    cut = ranged.withColumn("piece", piece_of("range", "id_hash")).drop("range")
    held = cut.groupBy("piece").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    # At most three times as many rows as there are ranges.
    sums = held.orderBy("piece").collect()
    bytes_before = np.cumsum([0, *[r.bytes for r in sums]]).tolist()
    rows_before = np.cumsum([0, *[r.rows for r in sums]]).tolist()
    starts = [(r.piece, bytes_before[k], rows_before[k]) for k, r in enumerate(sums)]
    offsets = spark.createDataFrame(starts, "piece int, bytes_before long, rows_before long")

    inside = Window.partitionBy("piece").orderBy("text_hash", "id_hash", "id", "size")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = cut.select(
        "*",
        (F.sum("size").over(running) - F.col("size")).alias("bytes_inside"),
        (F.row_number().over(inside) - 1).alias("rows_inside"),
    ).join(F.broadcast(offsets), "piece")
    at = F.col("bytes_before") + F.col("bytes_inside")
    placed = written(
        counted.select(
            "id",
            "size",
            "text_crc32",
            F.floor(at * shards / F.lit(max(total, 1))).cast("int").alias("shard"),
            (F.col("rows_before") + F.col("rows_inside")).alias("place"),
        ),
        "shard-places",
    )
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))  # a row per shard
    out = placed.join(F.broadcast(firsts), "shard")
    slot = (F.col("place") - F.col("first")).alias("slot")
    return out.select(F.col("id").alias(id_column), "size", "text_crc32", "shard", slot)
