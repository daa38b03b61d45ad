"""CSV in parts: several tasks read one file, also where quoted fields hold line breaks.

Lines come from the text source, which cuts files at will. Whether a line starts inside a
quoted field depends on all lines before it, but each block of lines is just a function from
one of two states to another: a first pass finds both outcomes of every block, a running
composition over the blocks, of which a file has few, gives the state that each starts in, and
a second pass puts lines together to records. Only records that a cut goes through are grouped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodwell.session import work_folder

#: So many blocks, of 128 MB by default, may have their states sent to every task.
SENT_BLOCKS = 1_000_000
BLOCKS = """file long, block long, returns boolean, after_outside long, after_quoted long,
 head string, first boolean, tail_outside string, tail_quoted string"""

OUTSIDE, QUOTED = 0, 1


def _marks(line: Column) -> Column:
    """What decides on a line's quotes: these and, of what stands between two, the last mark: a
    comma, or ``o`` for anything else. Empty without a quote."""
    marks = F.regexp_replace(line, '[^",]+', "o")
    return F.when(line.contains('"'), F.regexp_replace(marks, "[o,]+(?=[o,])", "")).otherwise("")


def _reader() -> Callable[[int, str], int]:
    outside, quoted = OUTSIDE, QUOTED

    def after(state: int, marks: str) -> int:
        """The state behind a line. A quote opens a field at its start alone and closes it, unless
        one more quote follows; behind a closed field anything up to the next comma belongs to it."""
        inside, closing, before = state == quoted, False, ","
        for mark in marks:
            if closing:
                closing = False
                if mark == '"':  # doubled
                    continue
                inside = False
            if inside:
                closing = mark == '"'
            else:
                inside = mark == '"' and before == ","
            before = mark
        return quoted if inside and not closing else outside

    return after


def _outcomes() -> Callable:
    after, outside, quoted = _reader(), OUTSIDE, QUOTED
    kinds = [pa.int64()] * 2 + [pa.bool_()] + [pa.int64()] * 2 + [pa.string(), pa.bool_()] + [pa.string()] * 2
    names = [field.split()[0] for field in BLOCKS.split(",")]

    class Block:
        """Both ways to read a block: from outside of quotes, and from within."""

        def __init__(self, file: int, block: int, returns: bool):
            self.place = (file, block, returns and block == 0)
            self.states = [outside, quoted]
            self.held: list[list[str]] = [[], []]  # lines of the record that is not closed yet
            self.closed = [False, False]
            self.head = None

        def add(self, line: str, marks: str) -> None:
            for way in (0, 1):
                self.held[way].append(line)
                if marks:
                    self.states[way] = after(self.states[way], marks)
                if self.states[way] == outside:
                    if way and not self.closed[way]:
                        self.head = "\n".join(self.held[way])
                    self.closed[way] = True
                    self.held[way].clear()

        def row(self) -> pa.RecordBatch:
            tails = ["\n".join(lines) if lines else None for lines in self.held]
            if not self.closed[1]:
                self.head, tails[1] = tails[1], None
            values = [*self.place, *self.states, self.head, not self.closed[0], *tails]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    def outcomes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            for file, block, line, marks, returns in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.place[:2] != (file, block):
                    if now:
                        yield now.row()
                    now = Block(file, block, returns)
                now.add(line, marks)
        if now:
            yield now.row()

    return outcomes


def _whole_records() -> Callable:
    after, outside = _reader(), OUTSIDE

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, state, skipped = None, outside, False
        held: list[str] = []
        for batch in batches:
            out = []
            for file, block, line, marks, start, returns in zip(*(c.to_pylist() for c in batch.columns)):
                if place != (file, block):
                    place, state = (file, block), start
                    # What began in another block, or names the columns.
                    skipped = start != outside or block == 0
                    held.clear()
                held.append(line.removesuffix("\r") if returns else line)
                if marks:
                    state = after(state, marks)
                if state == outside:
                    if not skipped:
                        out.append("\n".join(held))
                    held.clear()
                    skipped = False
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["record"])

    return whole


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: the text of each record but the first of a file, which names the columns.

    Lines end in a line feed or, if the file's first line does, in a carriage return and a line
    feed, which become a line feed inside a record. Empty records are left out. A quote that is
    never closed makes one record of what is left of its file. Files are read twice; a row for
    each block, with the records that its ends cut, is written in between.
    """
    read = spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
        _marks(F.col("value")).alias("marks"),
    )
    blocks = read.select("*", F.col("line").endswith("\r").alias("returns")).mapInArrow(_outcomes(), BLOCKS)

    # The last block with one outcome for both states fixes it; blocks behind that may turn it.
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("after_outside") == QUOTED) & (F.col("after_quoted") == OUTSIDE)
    turned = blocks.withColumn("turned", F.sum(turns.cast("int")).over(order) % 2)
    fixed = F.when(
        F.col("after_outside") == F.col("after_quoted"), (F.col("after_outside") + F.col("turned")) % 2
    )
    start = F.coalesce(F.last(fixed, True).over(before), F.lit(OUTSIDE)) + F.coalesce(
        F.lag("turned").over(order), F.lit(0)
    )
    started = turned.withColumn("start", (start % 2).cast("int"))
    outside = F.col("start") == OUTSIDE
    tail = F.when(outside, F.col("tail_outside")).otherwise(F.col("tail_quoted"))
    owner = F.last(F.when(tail.isNotNull(), F.col("block")), True).over(before)
    folder = work_folder(spark, "csv-blocks")
    placed = started.select(
        "file",
        "block",
        "start",
        F.max("returns").over(Window.partitionBy("file")).alias("returns"),
        owner.alias("owner"),
        F.when(~outside, F.col("head")).alias("head"),
        tail.alias("tail"),
        (outside & F.col("first") & (F.col("block") == 0)).alias("first"),
    )
    placed.write.parquet(folder)
    placed = spark.read.schema(placed.schema).parquet(folder)

    states = placed.select("file", "block", "start", "returns")
    few = states.limit(SENT_BLOCKS + 1).count() <= SENT_BLOCKS
    lines = read.withColumn("at", F.monotonically_increasing_id()).join(
        F.broadcast(states) if few else states, ["file", "block"]
    )
    if not few:  # the join has moved the lines
        lines = lines.sortWithinPartitions("file", "block", "at")
    whole = lines.select("file", "block", "line", "marks", "start", "returns").mapInArrow(
        _whole_records(), "record string"
    )

    def part(owner: Column, text: str, first: Column) -> Column:
        return F.struct(owner.alias("owner"), "block", F.col(text).alias("text"), first.alias("first"), "returns")

    parts = F.array(part(F.col("owner"), "head", F.lit(False)), part(F.col("block"), "tail", F.col("first")))
    cut = placed.select("file", F.inline(parts)).where("text IS NOT NULL").groupBy("file", "owner").agg(
        F.max("first").alias("first"),
        F.max("returns").alias("returns"),
        F.sort_array(F.collect_list(F.struct("block", "text"))).alias("parts"),
    )
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
    ended = F.regexp_replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), r"\r\z", "")
    joined = cut.where(~F.col("first")).select(F.when(F.col("returns"), ended).otherwise(text).alias("record"))
    return whole.unionByName(joined).where("record != ''")
