"""Periodic runs of words, found by catchers over completed power-of-two blocks.

The words of a text are appended one after another. On the level of a power of two, H, every H
words complete a block, and its catcher waits for squares whose period is H to 2H - 1 words. Each
appended word advances one comparison a level: the H words that end with it are held against the
block that began H to 2H - 1 words before they did; for a suffix of H words there is just one such
block. If they agree, the catcher reports that the text repeats itself at this distance. Reports of
one distance from one block after another merge; the words around them are compared to find where
the repetition starts and ends, and what is repeated often enough is a run.

A run of four periods or more holds a whole block of every level up to its period, and the next
copy of this block as well, so none is missed. What lies within a run of a lower level repeats
that run's period and is no news. Blocks are compared by sums over their words, hashed, modulo
2**64; a run is reported only after its words have been compared themselves.

The texts of an Arrow batch are appended one behind the other, each ended by a word that equals no
other, and the comparisons of a level are made together: about one addition and one comparison for
each word and level, in memory of a few numbers for each word.

Defined results: null and empty texts, and those of white space, have no words and no runs; the
collapsed text of null is empty. Repeated rows each get their result; an empty table gives an
empty result; texts are read whole; all other columns are kept, but for those with the names of
the results, which are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwell.operators.once import compute_once

#: A run has so many words at least, and so many periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Words appended together: texts of a batch are handled in groups of about this many.
TOGETHER = 500_000

RUNS = "array<struct<start: long, length: long, period: long>>"
FOUND = f"struct<runs: {RUNS}, collapsed: string>"


def _scrambled(numbers: np.ndarray) -> np.ndarray:
    """A hash of 64 bits for each number."""
    x = numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Catchers:
    """The words appended so far, and what the catchers of each level report of them."""

    BASE = 0x2545F4914F6CDD1D  # odd, hence with powers that do not vanish

    def __init__(self, words: np.ndarray):
        self.words = words
        powers = np.full(len(words) + 1, self.BASE, dtype=np.uint64)
        powers[0] = 1
        self.powers = np.multiply.accumulate(powers)
        # The words so far, each times the power of its place.
        self.sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(_scrambled(words) * self.powers[:-1], out=self.sums[1:])
        self.inverse = np.uint64(pow(self.BASE, -1, 1 << 64))
        self.unpowers = np.multiply.accumulate(
            np.concatenate([np.ones(1, np.uint64), np.full(len(words), self.inverse, np.uint64)])
        )

    def reports(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the blocks of ``size`` words that come again, and after how many words."""
        places = len(self.words) - size + 1
        whole = places // size * size
        if whole < 2 * size:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        last = (self.sums[size : size + whole] - self.sums[:whole]) * self.unpowers[:whole]
        rows = last.reshape(-1, size)
        block, offset = np.nonzero(rows[1:] == rows[:-1, :1])
        # The last places do not fill a row; their block is the one before.
        tail = (self.sums[size + whole :] - self.sums[whole:places]) * self.unpowers[whole:places]
        late = np.flatnonzero(tail == rows[-1, 0])
        starts = np.concatenate([block * size, np.full(len(late), whole - size, np.int64)])
        return starts, np.concatenate([offset, late]) + size

    def stretches(self, low: int, high: int, period: int) -> Iterator[tuple[int, int]]:
        """Where, from ``low`` to ``high``, words equal those a period on, as long as can be."""
        same = self.words[low:high] == self.words[low + period : high + period]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
        for first, end in edges.reshape(-1, 2):
            yield low + int(first), low + int(end)

    def runs(self, longest: int) -> list[tuple[int, int, int]]:
        """Start, length and period of all runs, if no text has more than ``longest`` words."""
        found: list[tuple[int, int, int]] = []
        size = 1
        while LEAST_PERIODS * size <= longest:
            starts, periods = self.reports(size)
            if found and len(starts):
                # The run that reaches furthest of those that start no later.
                begins, ends = np.array(sorted((s, s + n) for s, n, _ in found)).T
                reach = np.maximum.accumulate(ends)
                at = np.searchsorted(begins, starts, side="right") - 1
                news = (at < 0) | (reach[at] < starts + periods + size)
                starts, periods = starts[news], periods[news]
            found += self._merged(starts, periods, size)
            size *= 2
        return found

    def _merged(self, starts: np.ndarray, periods: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
        if not len(starts):
            return
        order = np.lexsort((starts, periods))
        starts, periods = starts[order], periods[order]
        apart = (np.diff(starts) != size) | (np.diff(periods) != 0)
        firsts = np.concatenate([[0], np.flatnonzero(apart) + 1])
        lasts = np.concatenate([firsts[1:], [len(starts)]]) - 1
        low, high, period = starts[firsts], starts[lasts] + size, periods[firsts]
        least = np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
        # A merged report may go on for less than a block on either side.
        enough = high - low + 2 * (size - 1) + period >= least
        for a, b, p, n in zip(low[enough], high[enough], period[enough], least[enough]):
            a, b, p = int(a), int(b), int(p)
            for first, end in self.stretches(max(0, a - size), min(b + size, len(self.words) - p), p):
                if end + p - first >= n:
                    yield first, end + p - first, p


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each of some texts, given as words, by start and period."""
    lengths = np.array([len(words) for words in texts], dtype=np.int64)
    flat = pa.array([w for words in texts for w in words], pa.binary()).dictionary_encode().indices
    numbers = np.asarray(flat, dtype=np.int64)
    bounds = np.cumsum(lengths + 1) - lengths - 1
    # Behind each text a number of its own.
    all_words = np.empty(len(numbers) + len(texts), dtype=np.int64)
    is_end = np.zeros(len(all_words), dtype=bool)
    is_end[bounds + lengths] = True
    all_words[~is_end] = numbers
    all_words[is_end] = -1 - np.arange(len(texts))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in Catchers(all_words).runs(int(lengths.max(initial=0))):
        k = int(np.searchsorted(bounds, start, side="right")) - 1
        out[k].append((start - int(bounds[k]), length, period))
    return [sorted(found, key=lambda r: (r[0], r[2])) for found in out]


def without_copies(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds behind its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept)]


def _finder() -> Callable[[Column], Column]:
    together = TOGETHER

    @F.pandas_udf(FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # Bytes are split at ASCII white space alone.
            texts = [[] if t is None else t.encode().split() for t in batch]
            found: list = []
            first = size = 0
            for last, words in enumerate(texts, 1):
                size += len(words)
                if size >= together or last == len(texts):
                    found += runs_of(texts[first:last])
                    first, size = last, 0
            yield pd.DataFrame(
                {
                    "runs": [
                        [{"start": s, "length": n, "period": p} for s, n, p in runs] for runs in found
                    ],
                    "collapsed": [
                        b" ".join(without_copies(words, runs)).decode() for words, runs in zip(texts, found)
                    ],
                }
            )

    return find


def find_runs(df: DataFrame, text_column: str = "text") -> DataFrame:
    """``runs`` (start, length and period, by start and period) and ``collapsed``: the words that no
    run holds behind its first period, joined by one space."""
    kept = [c for c in df.columns if c not in ("runs", "collapsed")]
    found = compute_once(df.select(*kept, _finder()(F.col(text_column)).alias("runs")), "runs")
    return found.select(*kept, "runs.runs", "runs.collapsed")


def longest_run(runs: Column) -> Column:
    """The run with the most words, the first of them, and of these the one of least period."""
    ranked = F.transform(
        runs, lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))
    )
    best = F.array_min(ranked)
    return F.when(
        F.size(runs) > 0,
        F.struct(best["start"].alias("start"), (-best["n"]).alias("length"), best["period"].alias("period")),
    )


def with_planted_runs(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Texts of a tenth of the ids, by checksum, go on as copies of a few of their words.

    Of such a text's n words, each from number ``a`` on becomes the one that stands as far behind
    ``a`` as the remainder of its distance by a period. A null id plants nothing.
    """
    key = F.crc32(F.col(id_column).cast("string").cast("binary"))
    chosen = (key % 10 == 0) & F.col(text_column).rlike(r"[^\x20\x09-\x0D]")
    g = F.floor(key / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        period = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(
            F.transform(
                words,
                lambda word, i: F.when(i < a, word).otherwise(F.get(words, (a + (i - a) % period).cast("int"))),
            ),
            " ",
        )

    words = F.array_remove(F.split(F.col(text_column), r"[\x20\x09-\x0D]+"), "")
    changed = F.get(F.transform(F.array(words), planted), 0)
    # A Python function does not take what higher-order functions give in the same step.
    return compute_once(df.withColumn(text_column, F.when(chosen, changed).otherwise(F.col(text_column))), text_column)
