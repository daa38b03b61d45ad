"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of a text's bytes in both directions and gives every position a
probability per language; a text's probabilities are the means over all its positions. It
is trained in numpy by backpropagation through time, on windows spread over the whole texts of
a bounded, balanced sample of labelled documents: ``per_language`` of each language, the least by
a hash, and at most ``languages`` languages. Every text is read whole.

Defined results: null texts and those without a letter are ``und`` with a score of 0, and so are all
texts if nothing can be learned from; null labels teach nothing; equal texts get equal
results; an empty table gives an empty result; all columns are kept, and columns named
like a result are replaced. Of ties the first language in order of name wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodwell.llm.common import let_go_but

WINDOW = 64  # bytes read together
PAD = 256
HIDDEN = 8  # in each direction
PER_LANGUAGE = 400  # sampled documents
LANGUAGES = 100
SLICES = (64, 8, 1)  # of a language's texts, in the steps in which the sample is drawn
WINDOWS_EACH = 8  # of a sampled document
STEPS, BATCH, RATE = 120, 128, 0.02
UNKNOWN = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class ByteTagger:
    """Weights: per direction, the inputs of a byte to three gates, and those of the state."""

    def __init__(self, languages: list[str], seed: int = 3):
        rng = np.random.default_rng(seed)
        h, self.languages = HIDDEN, languages
        self.w: dict[str, np.ndarray] = {}
        for side in "fb":
            self.w["x" + side] = rng.normal(0, 0.5, (PAD + 1, 3 * h)).astype(np.float32)
            self.w["u" + side] = rng.normal(0, 0.4, (h, 3 * h)).astype(np.float32)
        self.w["out"] = rng.normal(0, 0.3, (2 * h, len(languages))).astype(np.float32)
        self.w["bias"] = np.zeros(len(languages), dtype=np.float32)

    def _scan(self, side: str, steps: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States by step, for byte values by step and row."""
        h, x, u = HIDDEN, self.w["x" + side], self.w["u" + side]
        state = np.zeros((steps.shape[1], h), dtype=np.float32)
        states = np.empty((*steps.shape, h), dtype=np.float32)
        for t in range(len(steps)) if side == "f" else range(len(steps) - 1, -1, -1):
            given, own = x[steps[t]], state @ u
            gates = _sigmoid(given[:, : 2 * h] + own[:, : 2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            new = np.tanh(given[:, 2 * h :] + reset * own[:, 2 * h :])
            if keep is not None:
                keep.append((t, state, update, reset, own[:, 2 * h :], new))
            state = new + update * (state - new)
            states[t] = state
        return states

    def label(self, windows: np.ndarray) -> np.ndarray:
        """Probabilities by step, row and language."""
        steps = np.ascontiguousarray(windows.T)
        both = np.concatenate([self._scan("f", steps), self._scan("b", steps)], axis=2)
        scores = both @ self.w["out"] + self.w["bias"]
        scores = np.exp(scores - scores.max(axis=2, keepdims=True))
        return scores / scores.sum(axis=2, keepdims=True)

    def gradients(self, windows: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean loss over all positions that hold a byte."""
        h, steps = HIDDEN, np.ascontiguousarray(windows.T)
        kept = {"f": [], "b": []}
        both = np.concatenate([self._scan(s, steps, kept[s]) for s in "fb"], axis=2)
        scores = both @ self.w["out"] + self.w["bias"]
        scores = np.exp(scores - scores.max(axis=2, keepdims=True))
        error = scores / scores.sum(axis=2, keepdims=True)
        error[:, np.arange(len(wanted)), wanted] -= 1
        used = (steps != PAD)[:, :, None]
        error = (error * used / used.sum()).astype(np.float32)
        grads = {k: np.zeros_like(v) for k, v in self.w.items()}
        grads["out"] = np.einsum("tbh,tbl->hl", both, error)
        grads["bias"] = error.sum(axis=(0, 1))
        above = error @ self.w["out"].T
        for k, side in enumerate("fb"):
            u, gx, gu = self.w["u" + side], grads["x" + side], grads["u" + side]
            back = np.zeros((steps.shape[1], h), dtype=np.float32)
            for t, before, update, reset, own, new in reversed(kept[side]):
                d_state = back + above[t][:, k * h : (k + 1) * h]
                d_new = d_state * (1 - update) * (1 - new * new)
                d_update = d_state * (before - new) * update * (1 - update)
                d_reset = d_new * own * reset * (1 - reset)
                d_given = np.concatenate([d_update, d_reset, d_new], axis=1)
                d_own = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
                np.add.at(gx, steps[t], d_given)
                gu += before.T @ d_own
                back = d_state * update + d_own @ u.T
        return grads

    def train(self, windows: np.ndarray, wanted: np.ndarray, seed: int = 4) -> None:
        """Adam over random batches."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.w.items()}
        square = {k: np.zeros_like(v) for k, v in self.w.items()}
        for step in range(1, STEPS + 1):
            rows = rng.integers(0, len(windows), BATCH)
            rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
            for k, g in self.gradients(windows[rows], wanted[rows]).items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                fixed = np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8
                self.w[k] -= (rate * mean[k] / (1 - 0.9**step) / fixed).astype(np.float32)

    def pool(self, texts: list[bytes], rows: int = 2048) -> np.ndarray:
        """Mean probabilities of each text over all its positions; texts are not empty."""
        sizes = np.array([len(t) for t in texts])
        counts = -(-sizes // WINDOW)
        owner = np.repeat(np.arange(len(texts)), counts)
        padded = np.full(int(counts.sum()) * WINDOW, PAD, dtype=np.int16)
        firsts = np.cumsum(np.r_[0, counts[:-1]]) * WINDOW
        for text, first in zip(texts, firsts, strict=True):
            padded[first : first + len(text)] = np.frombuffer(text, dtype=np.uint8)
        windows = padded.reshape(-1, WINDOW)
        sums = np.zeros((len(texts), len(self.languages)))
        for start in range(0, len(windows), rows):
            part = windows[start : start + rows]
            found = self.label(part) * (part.T != PAD)[:, :, None]
            np.add.at(sums, owner[start : start + rows], found.sum(axis=0))
        return sums / sizes[:, None]


def train_tagger(
    labelled: DataFrame,
    text_column: str = "text",
    label_column: str = "lang",
    per_language: int = PER_LANGUAGE,
    languages: int = LANGUAGES,
) -> ByteTagger:
    """A network from a sample of labelled rows: of the ``languages`` labels with most rows (ties:
    the first by name) ``per_language`` texts each, those of the least hashes; only short windows of
    these reach the driver. Further labels are not learned, and never predicted."""
    text = F.col(text_column)
    n = F.char_length(text)
    spread = F.transform(
        F.sequence(F.lit(0), F.lit(WINDOWS_EACH - 1)),
        lambda k: F.substring(
            text,
            F.floor(k * F.greatest(n - WINDOW, F.lit(0)) / (WINDOWS_EACH - 1)).cast("int") + 1,
            F.lit(WINDOW),
        ),
    )
    rows = labelled.where(F.col(label_column).isNotNull() & text.rlike(r"\p{L}")).select(
        F.col(label_column).cast("string").alias("lang"),
        F.xxhash64(text).alias("h"),
        F.array_distinct(spread).alias("windows"),
    )
    often = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    names = sorted(r.lang for r in often.collect())
    rows = rows.where(F.col("lang").isin(names))
    # Copies count once, and only hashes travel for that. The least of each language are among the
    # least of its slices, so that no task gets more than what those leave.
    drawn = rows.select("lang", "h").distinct()
    for slices in SLICES:
        place = F.row_number().over(Window.partitionBy("lang", F.pmod("h", F.lit(slices))).orderBy("h"))
        drawn = drawn.withColumn("place", place).where(F.col("place") <= per_language).drop("place")
    sample = rows.join(F.broadcast(drawn), ["lang", "h"], "left_semi").distinct()
    tagger = ByteTagger(names)
    picked = sorted(sample.select("lang", "h", "windows").collect())
    texts = [(w.encode()[:WINDOW], names.index(r.lang)) for r in picked for w in r.windows if w]
    if not texts:
        return tagger
    windows = np.full((len(texts), WINDOW), PAD, dtype=np.int16)
    for row, (text, _) in zip(windows, texts, strict=True):
        row[: len(text)] = np.frombuffer(text, dtype=np.uint8)
    # As many windows of each language as of the most frequent one.
    wanted = np.array([k for _, k in texts])
    held = np.bincount(wanted, minlength=len(names))
    picks = np.concatenate([np.resize(np.flatnonzero(wanted == k), held.max()) for k in range(len(names))])
    tagger.train(windows[picks], wanted[picks])
    return tagger


def identify(df: DataFrame, tagger: ByteTagger, text_column: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``, from the text alone."""

    @F.pandas_udf("lang_pred string, score double")
    def tagged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        let_go_but("tagger")  # the network travels with the task
        for texts in batches:
            pred, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
            rows = np.flatnonzero(texts.notna().to_numpy()) if tagger.languages else []
            for start in range(0, len(rows), 200):
                part = rows[start : start + 200]
                shares = tagger.pool([texts.iloc[i].encode() for i in part])
                pred[part] = np.array(tagger.languages, dtype=object)[shares.argmax(axis=1)]
                score[part] = np.minimum(shares.max(axis=1), 1.0)
            yield pd.DataFrame({"lang_pred": pred, "score": score})

    lettered = F.when(F.col(text_column).rlike(r"\p{L}"), F.col(text_column))
    # So declared, it is run once, not once more in each filter on its results.
    out = df.withColumn("_tagged", tagged.asNondeterministic()(lettered))
    for name in ("lang_pred", "score"):
        out = out.withColumn(name, F.col(f"_tagged.{name}"))
    return out.drop("_tagged")


def held_out(id_column: Column, folds: int, fold: int) -> Column:
    """Whether a row is kept from learning: by the checksum of its id as text; null as empty."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds == fold
