"""Hashed words of texts and their costs per emotion.

A word's bucket is the sum of its letters, each times a power for its place, by a prime. Texts
are taken apart with numpy, many at a time; the functions handed to Spark are closures, so
executors need no copy of this package.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets, a prime: the size of a model per emotion, however much text trained it.
BUCKETS = 16381
#: Powers of BASE modulo BUCKETS for the places of a word; later places begin anew.
BASE, PLACES = 257, 64
COST_UNIT = 1000.0


def words_only(text: Column) -> Column:
    """Lower-cased text with each run of other characters as one space."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]+", " ")


def powers() -> list[int]:
    return [pow(BASE, k, BUCKETS) for k in range(PLACES)]


def _word_reader() -> Callable:
    buckets, places, step = BUCKETS, PLACES, 1 << 20
    weights = np.array(powers(), dtype=np.int64)

    def read(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Slices of the texts with the bucket of each word and the number of its text."""
        first, size = 0, 0
        for last, text in enumerate(texts, 1):
            size += len(text) + 1
            if size < step and last < len(texts):
                continue
            part = texts[first:last]
            codes = np.frombuffer(("\n".join(part) + "\n").encode("utf-32-le"), dtype="<u4").astype(np.int64)
            gap = (codes == 10) | (codes == 32)
            starts = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
            found = np.zeros(0, dtype=np.int64)
            if len(starts):
                began = np.zeros(len(codes), dtype=np.int64)
                began[starts] = starts
                place = np.arange(len(codes)) - np.maximum.accumulate(began)
                values = np.where(gap, 0, codes * weights[place % places])
                found = np.add.reduceat(values, starts) % buckets
            ends = np.cumsum([len(t) + 1 for t in part])
            yield first, last, found, np.searchsorted(ends, starts, side="right")
            first, size = last, 0

    return read


def word_counter() -> Callable:
    """For ``mapInPandas`` on ``label, words``: counts of each task, a row per label and bucket."""
    buckets, read = BUCKETS, _word_reader()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for label, words in batch.groupby("label")["words"]:
                total = totals.setdefault(label, np.zeros(buckets, dtype=np.int64))
                for _, _, found, _ in read(words.tolist()):
                    total += np.bincount(found, minlength=buckets)
        for label, total in totals.items():
            seen = np.flatnonzero(total)
            yield pd.DataFrame({"label": label, "bucket": seen.astype("int32"), "n": total[seen]})

    return count


def word_costs(costs: list[list[int]]) -> Callable[[Column], Column]:
    """Column function from words to the sum of their costs for each row of ``costs``."""
    read = _word_reader()
    table = np.array(costs, dtype=np.int64).reshape(len(costs), BUCKETS)

    def score(words: pd.Series) -> pd.Series:
        scored = pd.Series([None] * len(words), dtype=object)
        known = np.flatnonzero(words.notna().to_numpy())
        for first, last, found, owner in read(words.iloc[known].tolist()):
            sums = np.zeros((last - first, len(table)), dtype=np.int64)
            np.add.at(sums, owner, table[:, found].T)
            for place, row in zip(known[first:last], sums):
                scored[place] = row
        return scored

    return F.pandas_udf(score, T.ArrayType(T.LongType()))
