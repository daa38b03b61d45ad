"""Language scores from hashed letter pairs.

A profile holds one integer cost per language and bucket: ``-1000 ln`` of the
smoothed share. Integer sums are exact in any order, and the fixed number of
buckets bounds a profile at 16 KB per language however much text trained it.

Pairs are taken apart with numpy, a batch of texts at a time: the same sums in
higher-order functions cost ten times as much. The functions handed to Spark
are closures, so executors need no copy of this package.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwell.functions.chars import NO_LETTER

BUCKETS = 4093
COST_UNIT = 1000.0

# The language of text without letters, and the probability from
# which a second language counts.
DEFAULT_LANGUAGE = "en"
MIXED_FROM = 0.2

MAX_LANGUAGES = 1000

#: Pairs of letters in a part of a text, the last of which takes what is left over, and by how
#: much a part has to prefer another language than the text's, to count for that.
PART_PAIRS = 128
PART_MARGIN = 10_000

# Fixed value: the label of text in no known language.
UNKNOWN = "und"


def letters_only(text: Column) -> Column:
    """Lower-cased text with each run of non-letters as one space."""
    return F.regexp_replace(F.lower(text), f"{NO_LETTER}+", " ")


def _pair_reader() -> Callable:
    buckets, step = BUCKETS, 1 << 20

    def read(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Slices of the texts with the bucket of each pair and where each text starts.

        Every text ends in a line feed; pairs with one go to an extra bucket.
        """
        first, size = 0, 0
        for last, text in enumerate(texts, 1):
            size += len(text) + 1
            if size < step and last < len(texts):
                continue
            part = texts[first:last]
            joined = "\n".join(part) + "\n"
            codes = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4").astype(np.int64)
            following = np.append(codes[1:], 10)
            pairs = (codes * 257 + following) % buckets
            pairs[(codes == 10) | (following == 10)] = buckets
            lengths = np.array([len(t) + 1 for t in part])
            yield first, last, pairs, np.cumsum(lengths) - lengths
            first, size = last, 0

    return read


PAIR_COUNTS = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("n", T.LongType()),
    ]
)


def pair_counter() -> Callable:
    """For ``mapInPandas`` on ``lang, letters``: pair counts of each task."""
    buckets, read, most = BUCKETS, _pair_reader(), MAX_LANGUAGES

    def flush(totals: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
        for lang, total in totals.items():
            seen = np.flatnonzero(total[:buckets])
            yield pd.DataFrame(
                {"lang": lang, "bucket": seen.astype("int32"), "n": total[seen]}
            )
        totals.clear()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, letters in batch.groupby("lang")["letters"]:
                total = totals.setdefault(lang, np.zeros(buckets + 1, dtype=np.int64))
                for _, _, pairs, _ in read(letters.tolist()):
                    total += np.bincount(pairs, minlength=buckets + 1)
                if len(totals) > most:
                    yield from flush(totals)
        yield from flush(totals)

    return count


def bucket_cost(n: Column, total: Column) -> Column:
    return F.round(-COST_UNIT * F.ln((n + 1) / (total + BUCKETS))).cast("int")


def pair_scorer(costs: list[list[int]]) -> Callable[[Column], Column]:
    """Column function from letters to one cost per row of ``costs``; null without a pair."""
    buckets, read = BUCKETS, _pair_reader()
    table = np.array(costs, dtype=np.int64).reshape(len(costs), buckets)
    table = np.hstack([table, np.zeros((len(costs), 1), dtype=np.int64)])

    def score(letters: pd.Series) -> pd.Series:
        scored = pd.Series([None] * len(letters), dtype=object)
        known = np.flatnonzero(letters.notna().to_numpy())
        texts = letters.iloc[known].tolist()
        for first, last, pairs, starts in read(texts):
            counted = np.add.reduceat((pairs < buckets).astype(np.int64), starts)
            sums = np.stack([np.add.reduceat(row[pairs], starts) for row in table], axis=1)
            for place, n, row in zip(known[first:last], counted, sums):
                if n:
                    scored[place] = row
        return scored

    return F.pandas_udf(score, T.ArrayType(T.LongType()))


PARTED = "struct<costs: array<long>, pairs: long, other: double>"


def part_scorer(costs: list[list[int]]) -> Callable[[Column], Column]:
    """Column function from letters to the costs, how many pairs there are, and the share of them in
    parts that clearly prefer one other language; null without a pair."""
    buckets, read, size, margin = BUCKETS, _pair_reader(), PART_PAIRS, PART_MARGIN
    table = np.array(costs, dtype=np.int64).reshape(len(costs), buckets)
    table = np.hstack([table, np.zeros((len(costs), 1), dtype=np.int64)])

    def score(letters: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"costs": [None] * len(letters), "pairs": 0, "other": 0.0}, dtype=object)
        known = np.flatnonzero(letters.notna().to_numpy())
        texts = letters.iloc[known].tolist()
        for first, last, pairs, starts in read(texts):
            held = np.add.reduceat((pairs < buckets).astype(np.int64), starts)
            parts = np.maximum(1, held // size)
            opens = np.cumsum(parts) - parts
            owner = np.repeat(np.arange(len(parts)), parts)
            place = np.arange(len(owner)) - opens[owner]
            sums = np.stack([np.add.reduceat(row[pairs], starts[owner] + place * size) for row in table], axis=1)
            whole = np.add.reduceat(sums, opens, axis=0)
            best, wins = whole.argmin(axis=1), sums.argmin(axis=1)
            each = np.arange(len(owner))
            clear = sums[each, best[owner]] - sums[each, wins] > margin
            inside = np.where(place == parts[owner] - 1, held[owner] - place * size, size)
            others = np.zeros(whole.shape, dtype=np.int64)
            np.add.at(others, (owner[clear], wins[clear]), inside[clear])
            for at, n, row, most in zip(known[first:last], held, whole, others.max(axis=1)):
                if n:
                    out.iat[at, 0], out.iat[at, 1], out.iat[at, 2] = row.tolist(), int(n), float(most / n)
        return out

    return F.pandas_udf(score, PARTED)


def language_costs(costs: Column, langs: list[str]) -> Column:
    """``struct(cost, lang)`` per language, the most likely first."""
    names = F.array(*[F.lit(lang) for lang in langs])
    return F.sort_array(
        F.zip_with(
            costs, names, lambda c, name: F.struct(c.alias("cost"), name.alias("lang"))
        )
    )


def second_share(ranked: Column) -> Column:
    """Probability of the runner-up among ``language_costs``; null if there is none."""
    best = F.get(ranked, F.lit(0))["cost"]
    weights = F.transform(ranked, lambda c: F.exp((best - c["cost"]) / COST_UNIT))
    return F.get(weights, F.lit(1)) / F.aggregate(weights, F.lit(0.0), lambda a, w: a + w)
