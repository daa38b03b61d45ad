"""Substring deduplication by sliding spans of sentences.

A text is cut into sentences at full stops, question and exclamation marks and line ends. Nine words
in which no sentence ends are cut after the word of least hash, so that long sentences
fall into parts, too, and equal passages are cut alike but for the nine words at their ends. From every
cut on, and up to every sentence's end, the shortest run of sentences and parts that has 15 words is
hashed; longer ones would cover nothing else. A hash stands for the words alone. Equal runs meet over
all documents, and parts that are covered by any run but its first (in order of id, then place) go.
Any 50 words that two texts share, with the same sentence ends, hold a run: at most 16 of them stand
before its start, it has at most 23 and nine are left.

Each run travels once, as two hashes, its place and its document. Before that, a task drops what it
can tell by itself: of equal runs within a batch of texts all but the first go at once, as a
few covered stretches per document, so that a passage found everywhere travels once per batch.

Defined results: null, empty and short texts stay as they are; texts are read whole; rows
equal in id and text count as one document and are all treated as that one is; null ids come first;
an empty table gives an empty result; all columns are kept, and columns named like
a result are replaced. What is left is the untouched rest of the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodwell.llm.common import once_per_process

RUN_WORDS = 15  # words that a run has at least
WINDOW = 9  # words in a row, of which one ends a part
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd, one for each hash of a run

_TAIL = re.compile(r"[.!?][\"')\]]*\Z")
_MAY_END = frozenset(".!?\"')]")
_WORD = re.compile(r"\S+\s*")


def _cut(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words; how many words stand before each part and after the last; how many
    before each sentence and after the last."""
    words: list[str] = []
    ends = {0}
    for line in text.lower().split("\n"):
        words += line.split()
        ends.add(len(words))
    ends.update(i for i, w in enumerate(words, 1) if w[-1] in _MAY_END and _TAIL.search(w))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    sentences = np.array(sorted(ends))
    if len(words) < WINDOW:
        return hashes, sentences, sentences
    marked = np.zeros(len(words) + 1, dtype=bool)
    marked[sentences] = True
    ended = np.cumsum(marked)
    bare = np.flatnonzero(ended[WINDOW:] == ended[:-WINDOW])  # windows in which no sentence ends
    least = np.lib.stride_tricks.sliding_window_view(hashes, WINDOW)[bare].argmin(axis=1)
    marked[bare + least + 1] = True
    return hashes, np.flatnonzero(marked), sentences


def cut_sentences(text: str) -> list[tuple[int, int, int]]:
    """start, end and number of words of each part; together they are the text."""
    if not text:
        return []
    before = _cut(text)[1]
    if len(before) < 2:
        return [(0, len(text), 0)]
    places = np.array([0, *(m.end() for m in _WORD.finditer(text))])[before]
    places[0] = 0
    return list(zip(places[:-1].tolist(), places[1:].tolist(), np.diff(before).tolist(), strict=True))


def _spans(before: np.ndarray, sentences: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first part of every run, in order, and the part after its last."""
    n = len(before)
    ends = np.searchsorted(before, sentences)
    back = np.searchsorted(before, sentences - RUN_WORDS, side="right") - 1
    first = np.concatenate([np.arange(n), back])
    stop = np.concatenate([np.searchsorted(before, before + RUN_WORDS), ends])
    both = np.unique((first * (n + 1) + stop)[(first >= 0) & (stop < n)])
    return both // (n + 1), both % (n + 1)


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd number and of its inverse, modulo 2**64, up to the n-th at least."""
    held = once_per_process((__name__, base), dict)
    if len(held.get("powers", ())) <= n:
        grown = np.full(2 * n + 1000, base, dtype=np.uint64)
        back = np.full(len(grown), pow(base, -1, 1 << 64), dtype=np.uint64)
        grown[0] = back[0] = 1
        held.update(powers=np.cumprod(grown), inverse=np.cumprod(back))
    return held["powers"], held["inverse"]


def _runs(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """place, number of parts and two hashes of every run, as arrays.

    A hash is the sum of the words' hashes times the powers of an odd number; the words' hashes are
    mixed anew for the second, so that the two are independent.
    """
    words, before, sentences = _cut(text)
    first, stop = _spans(before, sentences)
    start, end = before[first], before[stop]
    out = []
    for base in BASES:
        powers, inverse = _powers(base, len(words))
        sums = np.append(np.uint64(0), np.cumsum(words * powers[: len(words)]))
        out.append(((sums[end] - sums[start]) * inverse[start]).view(np.int64))
        words = (words ^ (words >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        words ^= words >> np.uint64(29)
    return first, stop - first, *out


def run_hashes(text: str) -> list[tuple[int, int, int, int]]:
    """place, number of parts and two hashes of every run that has enough words."""
    return list(zip(*(a.tolist() for a in _runs(text)), strict=True))


def without(text: str, runs: list[tuple[int, int]]) -> tuple[str, int, int]:
    """The text without some runs (place, number of parts); how many parts it had and lost."""
    cut = cut_sentences(text)
    gone = {k for place, parts in runs for k in range(place, place + parts)}
    kept = "".join(text[s:e] for i, (s, e, _) in enumerate(cut) if i not in gone)
    return kept, len(cut), len(gone)


def _text_hash(column: str) -> Column:
    return F.xxhash64(F.col(column), F.octet_length(column))


def _ranks(ids: list, text_hashes: list[int]) -> np.ndarray:
    """Documents of a batch in order of id (null first) and text; equal ones share a number."""
    keys = [(i is not None, i if i is not None else 0, h) for i, h in zip(ids, text_hashes, strict=True)]
    number = {key: n for n, key in enumerate(sorted(set(keys)))}
    return np.array([number[key] for key in keys], dtype=np.int64)


def _stretches(docs: np.ndarray, place: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of documents, put together where they overlap or touch."""
    order = np.lexsort((place, docs))
    docs, place = docs[order], place[order]
    shift = docs * ((place + parts[order]).max(initial=0) + 2)  # documents lie apart on one line
    start, reach = place + shift, np.maximum.accumulate(place + parts[order] + shift)
    new = np.append(True, start[1:] > reach[:-1])[: len(start)]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)[: new.sum()]
    return docs[new], place[new], reach[last] - start[new]


def repeated_runs(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, text_hash, place and parts of all that is covered by runs that an earlier place has, too."""
    kind = df.schema[id_column].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_runs(text) for text in batch.column(3).to_pylist()]
            docs = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            if not len(docs):
                continue
            place, parts, h1, h2 = (np.concatenate(column) for column in zip(*found, strict=True))
            rank = _ranks(batch.column(0).to_pylist(), batch.column(1).to_pylist())[docs]
            order = np.lexsort((place, rank, h2, h1))
            same = np.append(False, (np.diff(h1[order]) == 0) & (np.diff(h2[order]) == 0))
            leader = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
            later = order[(rank[order] != rank[leader]) | (place[order] != place[leader])]
            known = _stretches(docs[later], place[later], parts[later])
            own = batch.column(2).to_numpy()[known[0]]
            first = np.sort(order[~same])  # in order of documents, which compresses better
            at = [docs[first], place[first], parts[first]]
            at, place, parts = (np.concatenate(both) for both in zip(at, known, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at)),
                    batch.column(1).take(pa.array(at)),
                    pa.array(place.astype(np.int32)),
                    pa.array(parts.astype(np.int32)),
                    pa.array(np.arange(len(at)) >= len(first)),
                    pa.array(np.append(h1[first], own)),
                    pa.array(np.append(h2[first], own)),
                ],
                ["id", "text_hash", "place", "parts", "later", "h1", "h2"],
            )

    texts = df.where(F.col(text_column).isNotNull()).select(
        F.col(id_column).alias("id"),
        _text_hash(text_column).alias("text_hash"),
        F.xxhash64(id_column, text_column).alias("own"),
        text_column,
    )
    rows = texts.mapInArrow(
        hashed, f"id {kind}, text_hash long, place int, parts int, later boolean, h1 long, h2 long"
    )
    # What is known to be covered goes along under a key of its document, away from the runs.
    equal = Window.partitionBy("later", "h1", "h2").orderBy("id", "text_hash", "place")
    order = F.struct("id", "text_hash", "place")
    first = F.first(order).over(equal.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = rows.withColumn("first", first).where(F.col("later") | ~order.eqNullSafe(F.col("first")))
    return met.select("id", "text_hash", "place", "parts")


def remove_repeats(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``df`` with the rest of each text, ``n_sentences`` (null if nothing went) and ``n_removed``."""
    found = repeated_runs(df, id_column, text_column)
    by = [F.col("id").alias("_run_id"), F.col("text_hash").alias("_run_hash")]
    places = found.groupBy(*by).agg(F.collect_set(F.struct("place", "parts")).alias("_runs"))

    @F.pandas_udf("text string, n_sentences long, n_removed long")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, places, parts in batches:
            rows = [
                (None, None, 0) if text is None else without(text, list(zip(at, n, strict=True)))
                for text, at, n in zip(texts, places, parts, strict=True)
            ]
            frame = pd.DataFrame(rows, columns=["text", "n_sentences", "n_removed"])
            yield frame.astype({"n_sentences": "Int64"})

    hit = F.col("_runs").isNotNull()
    same = F.col(id_column).eqNullSafe(F.col("_run_id")) & (_text_hash(text_column) == F.col("_run_hash"))
    joined = df.join(places, same, "left").withColumn(
        "_cut", cut(F.when(hit, F.col(text_column)), F.col("_runs.place"), F.col("_runs.parts"))
    )
    out = joined.withColumn(text_column, F.when(hit, F.col("_cut.text")).otherwise(F.col(text_column)))
    out = out.withColumn("n_sentences", F.col("_cut.n_sentences"))
    out = out.withColumn("n_removed", F.coalesce(F.col("_cut.n_removed"), F.lit(0)))
    return out.select(*[c for c in df.columns if c not in ("n_sentences", "n_removed")], "n_sentences", "n_removed")
