"""Benchmark decontamination by winnowing, with DataFrame functions alone.

The hashes of all k-grams of words pass through a sliding window, whose least hash is kept.
With k and the window both 7, two texts that share 13 words in a row share a kept hash.
Documents whose fingerprints meet a benchmark's are looked at again: around every hit,
their runs of 13 words are compared, word by word, with the benchmark's. An item of
fewer than 13 words is one run; as winnowing promises nothing for those, all grams of just
that many words are hashed instead.

Defined results: null texts and those without words have no words and no hits, an item
without words no runs; texts are read whole, however long; documents equal in id and text
get equal results, each its own row, and repeated items count once; empty tables give no rows or no
hits; other columns are not read. Fingerprints of a benchmark are sent to all tasks only
if they are counted to be few; more of them are joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwell.llm.common import let, sent_if_small, words_of, written

RUN = 13
GRAM = 7
WINDOW = RUN - GRAM + 1
_LENGTH = -1  # in place of a run's length: the row holds the text's


def _span(first: Column, last: Column) -> Column:
    """The numbers from first to last, none if last is smaller."""
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def _gram_hashes(words: Column, size: int) -> Column:
    """A hash per place; the size is part of what is hashed."""
    return F.transform(
        _span(F.lit(0), F.size(words) - size),
        lambda i: F.xxhash64(F.lit(size), *[F.get(words, i + k) for k in range(size)]),
    )


def _kept(hashes: Column) -> Column:
    """The least hash of each window, each once; minima of 2, 4 and then 7 places in a row."""

    def wider(least: Column, by: int) -> Column:
        ahead = F.slice(least, F.lit(1 + by), F.greatest(F.size(least) - by, F.lit(0)))
        return F.zip_with(least, ahead, lambda a, b: F.least(a, b))

    def cut(h: Column, least: Column) -> Column:
        full = F.greatest(F.size(h) - WINDOW + 1, F.lit(0))
        return F.array_distinct(F.slice(least, F.lit(1), full))

    return let(
        hashes,
        lambda h: let(
            wider(h, 1),
            lambda two: let(wider(two, 2), lambda four: cut(h, wider(four, 3))),
        ),
    )


def fingerprints(words: Column, short: list[int]) -> Column:
    """The winnowed hashes of a text, and all hashes of its grams of the short items' sizes."""
    kept = _kept(_gram_hashes(words, GRAM))
    return F.concat(kept, *[F.array_distinct(_gram_hashes(words, size)) for size in short])


def item_runs(items: DataFrame, item_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """item, size and run (its words) of every run of a benchmark."""
    words = items.select(F.col(item_column).alias("item"), words_of(F.col(text_column)).alias("words"))
    n = F.size("words")
    size = F.least(n, F.lit(RUN))
    starts = F.explode(_span(F.lit(1), n - size + 1))
    cut = words.where(n > 0).select("item", "words", size.alias("size"), starts.alias("start"))
    run = F.array_join(F.slice("words", F.col("start"), F.col("size")), " ").alias("run")
    return cut.select("item", "size", run).distinct()


def row_key(id_column: str, text_column: str) -> Column:
    """128 bits that stand for a document's id and text."""
    return F.unhex(
        F.md5(F.concat_ws("\x00", F.col(id_column).cast("string"), F.lit("|"), F.col(text_column)))
    )


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
) -> DataFrame:
    """``id, row_key, n_words, n_hit, items`` (sorted as strings) of every document. Runs jobs at once."""
    spark = docs.sparkSession
    runs = written(item_runs(items, item_column, text_column), "runs")
    # At most RUN - 1 numbers.
    found = runs.where(F.col("size") < RUN).select("size").distinct().collect()
    short = sorted(r["size"] for r in found)
    held = runs.select(F.explode(let(F.split("run", " "), lambda w: fingerprints(w, short))).alias("hash"))
    wanted = held.distinct()
    prints = sent_if_small(written(wanted, "fingerprints"))

    worded = docs.select(
        F.col(id_column).alias("id"),
        row_key(id_column, text_column).alias("key"),
        words_of(F.col(text_column)).alias("words"),
    )
    # Under -1, the text's length; it goes along with the hashes, so that texts are read once here.
    length = F.struct(F.lit(_LENGTH).alias("kind"), F.size("words").cast("long").alias("hash"))
    marks = F.transform(
        fingerprints(F.col("words"), short),
        lambda h: F.struct(F.lit(0).alias("kind"), h.alias("hash")),
    )
    marked = worded.select("id", "key", F.inline(F.concat(F.array(length), marks)))
    lengths = F.col("kind") == _LENGTH
    hits = marked.where(~lengths).join(prints, "hash", "left_semi")
    met = written(marked.where(lengths).unionByName(hits), "hits")

    suspects = written(
        met.where(~lengths).groupBy("key").agg(F.collect_set("hash").alias("hits")), "suspects"
    )
    near = worded.join(sent_if_small(suspects), "key")

    def tries(size: int, gram: int) -> Column:
        starts = _near(_gram_hashes(F.col("words"), gram), F.col("hits"), size - gram + 1)
        return F.transform(starts, lambda p: F.struct(p.alias("start"), F.lit(size).alias("size")))

    places = F.concat(tries(RUN, GRAM), *[tries(size, size) for size in short])
    tried = near.select("key", "words", F.inline(places)).select(
        "key",
        "start",
        "size",
        F.array_join(F.slice("words", F.col("start"), F.col("size")), " ").alias("run"),
    )
    same = tried.distinct().join(runs, ["size", "run"])
    ends = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end"))))
    per_doc = same.groupBy("key").agg(
        _covered(ends).alias("n_hit"),
        F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"),
    )
    totals = met.where(lengths).select("id", "key", F.col("hash").alias("n_words"))
    return totals.join(per_doc, "key", "left").select(
        F.col("id").alias(id_column),
        F.col("key").alias("row_key"),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _near(hashes: Column, hits: Column, reach: int) -> Column:
    """Where a run starts that holds a hit within its first ``reach`` grams; places from 1."""
    return let(
        hashes,
        lambda h: F.filter(
            _span(F.lit(1), F.size(h) - reach + 1),
            lambda p: F.arrays_overlap(F.slice(h, p, F.lit(reach)), hits),
        ),
    )


def _covered(spans: Column) -> Column:
    """How many places some sorted spans cover."""
    start = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("reached"))

    def add(seen: Column, span: Column) -> Column:
        more = F.greatest(F.lit(0), span["end"] - F.greatest(span["start"], seen["reached"]))
        return F.struct(
            (seen["covered"] + more).alias("covered"),
            F.greatest(seen["reached"], span["end"]).alias("reached"),
        )

    return F.aggregate(spans, start, add, lambda seen: seen["covered"])


def is_contaminated() -> Column:
    """At least a twentieth of the words stand in benchmark runs."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def decontaminate(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    found = find_contamination(docs, items, id_column, text_column)
    # Ids may be null or repeated: only rows equal in id and text go together.
    bad = found.where(is_contaminated()).select(F.col("row_key").alias("_bad")).distinct()
    same = row_key(id_column, text_column) == F.col("_bad")
    return docs.join(sent_if_small(written(bad, "contaminated")), same, "left_anti")
