"""Scores of a log-bilinear language model, trained with noise-contrastive estimation.

Words in a context of four predict the next one: their vectors, weighted by place, add up
to a vector whose products with the targets' vectors, and biases, are scores. The most frequent
words and the end of a text are targets of their own. All others, seen in training or not, are dealt to
shared targets by a checksum. Within a shared target the context predicts the word itself, in two steps: one of
the target's frequent words or one of its groups, then a word of that group. So each word of the dictionary has a
vector of its own as a target; in contexts the words of a shared target have one vector. Words outside the
dictionary are a group's rest, within which a word's share follows its count in the whole corpus. Every task trains
on all the training text it reads, from the same start, against noise drawn from the counts; the models are
averaged by the words they have seen. Scoring takes products with all targets, and with all words of the group at
each step, and normalises them.

Counts of all words are a table; what travels to every task is a dictionary of at most
``known`` frequent words. Other words' counts come by a join, their targets from the words themselves.

Defined results: a null text counts as empty, which is an end alone; A to Z count as lower case;
texts are read whole; rows equal in id and text get equal scores, each its own row; without
training rows all words are unknown; a null id is checked as an empty one; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwell.llm.common import once_per_process, text_key, written

CONTEXT = 4
TARGETS = 256
SHARED = 64  # of these, the last ones, are shared by the words that have none of their own
SIZE = 16  # of a vector
FREQUENT = 112  # words of a shared target that are in none of its groups
GROUPS = 1024  # of rarer words, as many in each shared target
NOISE = 32  # drawn words per step
NOISE_WITHIN = 16  # the same within a shared target or a group
BATCH = 2048  # tokens scored together
STEP = 1024  # tokens of a training step
TRAINED = 512 * STEP  # tokens that are gathered before they are trained on
SCORED = 1 << 20  # bytes of text, and
ROWS = 1000  # rows, that are gathered before they are scored
PART = 256  # leaves whose vectors are summed as one row
RATE = 0.1
RATE_WITHIN = 0.05  # for leaves, which fewer tokens are seen of
KNOWN = 200_000  # words in the dictionary that travels
HELD = 200_000  # words that a counting task gathers before it passes them on
END = b" "  # no word holds a space
_LONG = 48


def tokens_of(text: str | bytes | None) -> list[bytes]:
    """Words in lower case (A to Z), then the end; very long words by a digest no word can equal."""
    given = text.encode() if isinstance(text, str) else text or b""
    words = given.lower().split()
    if max(map(len, words), default=0) > _LONG:
        words = [w if len(w) <= _LONG else b" " + hashlib.sha256(w).digest() for w in words]
    words.append(END)
    return words


def _bytes_of(texts: pa.Array) -> list[bytes | None]:
    """Texts of a batch as they are in memory, without a string made of each."""
    return texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()).to_pylist()


def count_tokens(texts: DataFrame) -> DataFrame:
    """token and c, over all rows of ``text``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passed() -> pa.RecordBatch:
            tokens = pa.array(list(held), pa.binary())
            return pa.RecordBatch.from_arrays([tokens, pa.array(held.values(), pa.int64())], ["token", "c"])

        held: Counter = Counter()
        for batch in batches:
            for text in _bytes_of(batch.column(0)):
                held.update(tokens_of(text))
                if len(held) >= HELD:
                    yield passed()
                    held.clear()
        if held:
            yield passed()

    parts = texts.mapInArrow(count, "token binary, c long")
    return parts.groupBy("token").agg(F.sum("c").alias("c"))


class Model:
    """Vectors of context words and targets, weights by place, biases."""

    def __init__(self, log_shares: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        n = len(log_shares)
        self.log_shares = log_shares.astype(np.float32)
        up_to = np.exp(self.log_shares.astype(np.float64)).cumsum()
        self.up_to = up_to / up_to[-1]  # from which noise is drawn
        self.parts = {
            "words": rng.normal(0, 0.1, (n, SIZE)).astype(np.float32),
            "places": np.full((CONTEXT, SIZE), 1 / CONTEXT, dtype=np.float32),
            "targets": rng.normal(0, 0.1, (n, SIZE)).astype(np.float32),
            "bias": self.log_shares.copy(),
        }

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts.values()])

    def load(self, values: np.ndarray) -> None:
        at = 0
        for name, part in self.parts.items():
            self.parts[name] = values[at : at + part.size].reshape(part.shape).astype(np.float32)
            at += part.size

    def weighted(self) -> np.ndarray:
        """The words' vectors as they count at each place."""
        return self.parts["words"] * self.parts["places"][:, None]

    def predict(self, before: np.ndarray) -> np.ndarray:
        weighted = self.weighted()
        return sum(weighted[i].take(before[:, i], axis=0) for i in range(CONTEXT))

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What a word at a place adds to each target's score (with the bias, at the first one); the greatest
        of that; and the powers of e of the rest. Of a fixed size, whatever the number of tokens."""
        adds = self.weighted().astype(np.float64) @ self.parts["targets"].T.astype(np.float64)
        adds[0] += self.parts["bias"]
        most = adds.max(axis=2)
        return adds, most, np.exp(adds - most[:, :, None]).astype(np.float32)

    def log_probabilities(self, before: np.ndarray, wanted: np.ndarray, tables: tuple | None = None) -> np.ndarray:
        """Natural logarithms, normalised over all targets. A score is a sum over places, so that its power
        of e is a product of what ``tables`` holds: none has to be taken for a token."""
        adds, most, powers = tables or self.tables()
        at = [before[:, i] for i in range(CONTEXT)]
        product = powers[0].take(at[0], axis=0)
        for i in range(1, CONTEXT - 1):
            product *= powers[i].take(at[i], axis=0)
        total = np.einsum("ij,ij->i", product, powers[-1].take(at[-1], axis=0))
        own = sum(adds[i][at[i], wanted] - most[i][at[i]] for i in range(CONTEXT))
        # So small that single precision loses it: done apart.
        low = np.flatnonzero(total < 1e-30)
        if len(low):
            apart = sum(adds[i][at[i][low]] for i in range(CONTEXT))
            top = apart.max(axis=1, keepdims=True)
            own[low] = (apart - top)[np.arange(len(low)), wanted[low]]
            total = total.astype(np.float64)
            total[low] = np.exp(apart - top).sum(axis=1)
        return own - np.log(total, dtype=np.float64)

    def made(self, before: np.ndarray) -> np.ndarray:
        """What contexts predict, and a one that biases are taken with."""
        weighted = self.weighted()
        out = np.ones((len(before), SIZE + 1), dtype=np.float32)
        for start in range(0, len(before), BATCH):  # what is added up stays near the processor
            part = before[start : start + BATCH]
            total = weighted[0].take(part[:, 0], axis=0)
            for i in range(1, CONTEXT):
                total += weighted[i].take(part[:, i], axis=0)
            out[start : start + BATCH, :SIZE] = total
        return out

    def train(self, before: np.ndarray, wanted: np.ndarray, rng: np.random.Generator, sums: dict) -> None:
        """One step against shared noise; ``sums`` has the squared gradients so far."""
        p, n, b = self.parts, len(self.log_shares), len(wanted)
        drawn = self.up_to.searchsorted(rng.random(NOISE), side="right")
        drawn, times = np.unique(drawn, return_counts=True)
        made = self.predict(before)
        least = np.log(NOISE) + self.log_shares

        def error(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
            """Chance, by the model, that a word is data and not noise."""
            x = least[ids] - scores
            np.minimum(x, 30, out=x)
            np.exp(x, out=x)
            x += 1
            return np.reciprocal(x, out=x)

        own, noise = p["targets"].take(wanted, axis=0), p["targets"][drawn]
        right = error((made * own).sum(axis=1) + p["bias"][wanted], wanted)[:, None] - 1
        wrong = error(made @ noise.T + p["bias"][drawn], drawn)
        wrong *= times
        d_made = right * own + wrong @ noise
        # Sums by word of what reaches each place: the weights of places are applied to these sums,
        # which are few, and not to the tokens.
        met = np.stack([_gather(before[:, i], d_made, n) for i in range(CONTEXT)])
        grads = {
            "targets": _gather(wanted, right * made, n),
            "bias": np.bincount(wanted, right[:, 0], n),
            "words": np.einsum("iwd,id->wd", met, p["places"].astype(np.float64)),
            "places": np.einsum("iwd,wd->id", met, p["words"].astype(np.float64)),
        }
        grads["targets"][drawn] += wrong.T @ made
        grads["bias"][drawn] += wrong.sum(axis=0)
        for name, g in grads.items():
            g = g / b
            sums[name] = sums.get(name, 1e-6) + g * g
            p[name] -= (RATE * g / np.sqrt(sums[name])).astype(np.float32)


class Leaves:
    """Vectors, and biases, of words within shared targets and groups, and of groups: as they start, a word has the
    share of its count. ``bounds`` says where each group's leaves begin, shared targets first."""

    def __init__(self, bounds: np.ndarray, log_shares: np.ndarray):
        self.bounds, self.log_shares = bounds, log_shares.astype(np.float32)
        sizes = np.diff(bounds)
        self.group = np.repeat(np.arange(len(sizes), dtype=np.int16), sizes)
        sums = np.exp(log_shares.astype(np.float64)).cumsum()
        last = np.r_[0, sums][bounds]
        self.up_to = (sums - last[self.group]) / np.diff(last)[self.group] + self.group  # from which noise is drawn
        self.up_to[bounds[1:] - 1] = np.arange(1, len(bounds))
        self.values = np.zeros((len(log_shares), SIZE + 1), dtype=np.float32)

    def _grouped(self, leaves: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """The order of leaves by group, and each group met with its span in that."""
        groups = self.group.take(leaves)
        n = np.bincount(groups, minlength=len(self.bounds) - 1)
        ends = n.cumsum()
        return groups.argsort(kind="stable"), [(g, ends[g] - n[g], ends[g]) for g in np.flatnonzero(n).tolist()]

    def log_probabilities(self, made: np.ndarray, at: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        """Natural logarithms, normalised over the leaves of a group; ``at`` says which row of ``made`` is meant."""
        order, spans = self._grouped(leaves)
        made, leaves = made.take(at[order], axis=0), leaves[order]
        longest = [np.sqrt((x**2).sum(axis=1).max(initial=0)) for x in (made, self.values)]
        small = longest[0] * longest[1] < 60  # no power of e is too large
        found = np.empty(len(leaves))
        for g, start, end in spans:
            first, last = self.bounds[g : g + 2]
            vectors = self.values[first:last].T.copy()
            vectors[-1] += self.log_shares[first:last]
            ones = np.ones(last - first, dtype=np.float32)
            for s in range(start, end, BATCH):
                e = min(s + BATCH, end)
                scores = made[s:e] @ vectors
                own = scores.ravel().take(np.arange(0, scores.size, len(ones)) + (leaves[s:e] - first))
                if not small:
                    top = scores.max(axis=1)
                    scores -= top[:, None]
                    own = own - top
                found[s:e] = own - np.log(np.exp(scores, out=scores) @ ones)
        out = np.empty(len(leaves))
        out[order] = found
        return out

    def train(self, made: np.ndarray, at: np.ndarray, leaves: np.ndarray, rng: np.random.Generator, sums: np.ndarray) -> None:
        """Steps of each group against its own noise; ``sums`` has the squared gradients so far. A leaf's noise
        has its share, so that shares cancel out and products are left."""
        order, spans = self._grouped(leaves)
        made, leaves = made.take(at[order], axis=0), leaves[order]
        if not spans:
            return
        steps = [(g, s, min(s + STEP, end)) for g, start, end in spans for s in range(start, end, STEP)]
        chosen = np.array([g for g, _, _ in steps])[:, None] + rng.random((len(steps), NOISE_WITHIN))
        drawn = self.up_to.searchsorted(chosen, side="right")
        for (g, s, e), noise in zip(steps, drawn):
            first, last = self.bounds[g : g + 2]
            vectors, x, own = self.values[first:last], made[s:e], leaves[s:e] - first
            noise = noise - first
            right = np.einsum("ij,ij->i", x, vectors.take(own, axis=0))
            wrong = x @ vectors.take(noise, axis=0).T
            for scores in (right, wrong):  # chances, by the model, that a word is data and not noise
                np.subtract(np.float32(np.log(NOISE_WITHIN)), scores, out=scores)
                np.minimum(scores, 30, out=scores)
                np.exp(scores, out=scores)
                scores += 1
                np.reciprocal(scores, out=scores)
            right -= 1
            grad = _gather(np.concatenate([own, noise]), np.concatenate([x * right[:, None], wrong.T @ x]), last - first).astype(np.float32)
            sums[first:last] += grad * grad
            grad *= np.float32(RATE_WITHIN)
            grad /= np.sqrt(sums[first:last])
            vectors -= grad


def _gather(ids: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by id."""
    size = rows.shape[1]
    flat = np.arange(n * size).reshape(n, size).take(ids, axis=0)
    return np.bincount(flat.ravel(), rows.ravel(), n * size).reshape(n, size)


def contexts(classes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The classes before each token, beginning with ends, and the tokens' own classes."""
    lead = np.zeros(CONTEXT, dtype=np.int64)
    line = np.concatenate([x for c in classes for x in (lead, c)])
    sizes = np.array([len(c) for c in classes])
    starts = np.cumsum(np.r_[0, sizes[:-1]]) + CONTEXT * np.arange(1, len(classes) + 1)
    at = np.repeat(starts - np.cumsum(np.r_[0, sizes[:-1]]), sizes) + np.arange(sizes.sum())
    # Place by place, so that the words of one lie together.
    return line.take(at - np.arange(1, CONTEXT + 1)[:, None]).T, line.take(at)


def shared_target(word: bytes) -> int:
    """Which of the shared targets a word has, if none is its own."""
    return zlib.crc32(word) % SHARED


def group_of(word: bytes) -> int:
    """The group that a word is in, if it has no place of its own; those of a shared target follow in its steps."""
    return zlib.crc32(word) % GROUPS


class Places(dict):
    """Places of words in the dictionary; of any other word, below zero, by its group."""

    def __missing__(self, word: bytes) -> int:
        return ~group_of(word)


def places_of(tokens: list[bytes], place: Places) -> np.ndarray:
    return np.array(itemgetter(END, *tokens)(place)[1:], dtype=np.int64)  # of two or more it gives a tuple


class Dictionary:
    """Frequent words, most frequent first after the end, and their counts; ``dealt`` has the counts
    and the number of words that each group would have, had no word a place of its own."""

    def __init__(self, words: list[bytes], counts: list[int], total: int, distinct: int, dealt: np.ndarray):
        self.words, self.counts = words, np.array(counts, dtype=np.int64)
        self.total, self.distinct = total, distinct
        self.own = min(TARGETS - SHARED, len(words))  # targets of their own
        rest = dealt.reshape(2, -1, SHARED).sum(axis=1)
        for word, count in zip(words[: self.own], counts):
            rest[:, shared_target(word)] -= count, count > 0
        shares = np.r_[self.counts[: self.own], rest[0]] + 1.0
        self.log_shares = np.log(shares / shares.sum())
        # Within a shared target a word has its count and one, and words never seen have one.
        self.log_shared = np.log10(rest.sum(axis=0) + 1.0)
        self._place_leaves(dealt)
        self.name = uuid.uuid4().hex

    def _place_leaves(self, dealt: np.ndarray) -> None:
        """Leaves: the frequent words of a shared target and its groups; then each group's words and its rest."""
        groups = np.array([group_of(w) for w in self.words], dtype=np.int64)
        mass = self.counts + (self.counts > 0.0)
        rest = dealt.sum(axis=0) + 1.0 - np.bincount(groups, mass, GROUPS)
        words = np.arange(self.own, len(groups))
        by = np.argsort(groups[words] % SHARED, kind="stable")  # the most frequent first within each
        target = groups[words][by] % SHARED
        frequent = np.empty(len(words), dtype=bool)
        frequent[by] = np.arange(len(by)) - np.searchsorted(target, target) < FREQUENT
        ones, others, every = words[frequent], words[~frequent], np.arange(GROUPS)
        held = rest + np.bincount(groups[others], mass[others], GROUPS)
        parents = np.r_[groups[ones] % SHARED, every % SHARED, SHARED + groups[others], SHARED + every]
        shares = np.r_[mass[ones], held, mass[others], rest]
        order = np.argsort(parents, kind="stable")
        leaf = np.empty(len(order), dtype=np.int32)
        leaf[order] = np.arange(len(order))
        at_ones, at_groups, at_others, at_rest = np.split(leaf, np.cumsum([len(ones), GROUPS, len(others)]))
        self.bounds = np.searchsorted(parents[order], np.arange(SHARED + GROUPS + 1))
        self.log_leaves = np.log(shares / np.bincount(parents, shares)[parents])[order]
        self.log_rest = np.log10(rest)
        # Of each place, and of other words behind: the leaves at both steps, -1 for none.
        self.steps = np.full((2, len(groups) + GROUPS), -1, dtype=np.int32)
        self.steps[0, ones], self.steps[0, others], self.steps[1, others] = at_ones, at_groups[groups[others]], at_others
        self.steps[:, len(groups) :] = at_groups[::-1], at_rest[::-1]

    def leaves(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which tokens are within a shared target; which of these each leaf is of, at both steps; the leaves."""
        first = self.steps[0].take(places, mode="wrap")
        tokens = np.flatnonzero(first >= 0)
        second = self.steps[1].take(places[tokens], mode="wrap")
        deeper = np.flatnonzero(second >= 0)
        return tokens, np.r_[np.arange(len(tokens)), deeper], np.r_[first[tokens], second[deeper]]

    def lookup(self) -> tuple[Places, np.ndarray]:
        """Places of words, and the targets by place, those of other words behind."""

        def make() -> tuple[Places, np.ndarray]:
            shared = [self.own + shared_target(w) for w in self.words[self.own :]]
            behind = [self.own + group % SHARED for group in range(GROUPS - 1, -1, -1)]
            return Places(zip(self.words, range(len(self.words)))), np.array([*range(self.own), *shared, *behind])

        return once_per_process(("words", self.name), make)


def rebuilt(kind: type, state: dict):
    """An object from what was sent of it."""
    made = object.__new__(kind)
    vars(made).update(state)
    return made


def make_dictionary(counts: DataFrame, known: int) -> Dictionary:
    """From the table of counts; at most ``known`` words and some counts reach the driver."""
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    total, distinct = sums.n or 0, sums.v
    # How many words have each count, from the top: the least count down to which the dictionary
    # can hold all. Each count has a word at least, so that no more counts than words are asked for.
    levels = counts.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).limit(known + 1)
    least, held = None, 0
    for r in levels.collect():
        held += r.n
        if held > known:
            break
        least = r.c
    words = [] if least is None else counts.where(F.col("c") >= least).collect()
    picked = sorted(((-r.c, bytes(r.token)) for r in words), key=lambda x: (x[1] != END, x))
    if not picked or picked[0][1] != END:
        ends = counts.where(F.col("token") == END).collect()
        picked = [(-sum(r.c for r in ends), END), *picked]
    dealt = np.zeros((2, GROUPS), dtype=np.int64)
    by_group = counts.groupBy((F.crc32("token") % GROUPS).alias("k"))
    for r in by_group.agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        dealt[:, r.k] = r.n, r.v
    return Dictionary([w for _, w in picked], [-c for c, _ in picked], total, distinct, dealt)


def train_model(texts: DataFrame, dictionary: Dictionary) -> tuple[Model, Leaves]:
    """A model from all rows of ``text``: each task trains one, and their mean is taken, for leaves by
    how often a task has seen each."""
    sent = texts.sparkSession.sparkContext.broadcast(vars(dictionary))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = rebuilt(Dictionary, sent.value)
        (place, targets), model, sums = words.lookup(), Model(words.log_shares), {}
        leaves, seen_leaves = Leaves(words.bounds, words.log_leaves), np.zeros(len(words.log_leaves))
        leaf_sums = np.ones(leaves.values.shape, dtype=np.float32)
        rng, seen, waiting, size = np.random.default_rng(17), 0, [], 0

        def trained() -> int:
            before, wanted = contexts([targets.take(p) for p in waiting])
            for start in range(0, len(wanted), STEP):
                model.train(before[start : start + STEP], wanted[start : start + STEP], rng, sums)
            tokens, at, met = words.leaves(np.concatenate(waiting))
            leaves.train(model.made(before.T.take(tokens, axis=1).T), at, met, rng, leaf_sums)
            np.add(seen_leaves, np.bincount(met, minlength=len(seen_leaves)), out=seen_leaves)
            return len(wanted)

        for batch in batches:
            for text in _bytes_of(batch.column(0)):
                waiting.append(places_of(tokens_of(text), place))
                size += len(waiting[-1])
                if size >= TRAINED:
                    seen += trained()
                    waiting, size = [], 0
        if waiting:
            seen += trained()
        if seen:
            rows = [(-1, (model.flat().astype(np.float64) * seen).tobytes(), np.array([float(seen)]).tobytes())]
            for start in range(0, len(seen_leaves), PART):
                n = seen_leaves[start : start + PART]
                if n.any():
                    values = leaves.values[start : start + PART] * n[:, None]
                    rows.append((start, values.astype(np.float32).tobytes(), n.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["start", "sums", "seen"])

    def add(parts: pa.Table) -> pa.Table:
        start = parts["start"][0].as_py()
        kinds = {"sums": np.float64 if start < 0 else np.float32, "seen": np.float64}
        added = [sum(np.frombuffer(x.as_buffer(), kind).astype(np.float64) for x in parts[name]) for name, kind in kinds.items()]
        return pa.table({"start": [start], "sums": [added[0].tobytes()], "seen": [added[1].tobytes()]})

    parts = texts.mapInArrow(learn, "start long, sums binary, seen binary")
    added = parts.groupBy("start").applyInArrow(add, "start long, sums binary, seen binary")
    model, leaves = Model(dictionary.log_shares), Leaves(dictionary.bounds, dictionary.log_leaves)
    for r in added.collect():  # of a set size: weights, and vectors of the dictionary's words
        values, seen = np.frombuffer(r.sums), np.frombuffer(r.seen)
        if r.start < 0:
            model.load(values / seen[0])
        else:
            leaves.values[r.start : r.start + PART] = values.reshape(-1, SIZE + 1) / np.maximum(seen, 1)[:, None]
    return model, leaves


def score_texts(
    df: DataFrame,
    held_out: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    known: int = KNOWN,
) -> DataFrame:
    """Scores of every row by a model of the rows not held out. Runs jobs at once."""
    train = df.where(~held_out).select(F.col(text_column).alias("text"))
    counts = written(count_tokens(train), "token-counts")
    dictionary = make_dictionary(counts, known)
    model, leaves = train_model(train, dictionary)
    sent = df.sparkSession.sparkContext.broadcast((vars(dictionary), vars(model), vars(leaves)))
    n, v = dictionary.total, dictionary.distinct
    kind = df.schema[id_column].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, fitted, within = map(rebuilt, (Dictionary, Model, Leaves), sent.value)
        logs, tables = np.log10(words.counts + 1.0), fitted.tables()
        for batch in batches:
            texts, start, held = _bytes_of(batch.column("text")), 0, 0
            for row, text in enumerate(texts, 1):
                held += len(text or b"")
                if held >= SCORED or row - start == ROWS or row == len(texts):
                    tokens = [tokens_of(t) for t in texts[start:row]]
                    yield _scored(batch.slice(start, row - start), tokens, logs, words, fitted, tables, within)
                    start, held = row, 0

    def _scored(part, tokens, logs, words, fitted, tables, within) -> pa.RecordBatch:
        place, targets = words.lookup()
        sizes = np.array([len(t) for t in tokens])
        parts = [places_of(t, place) for t in tokens]
        ids = np.concatenate(parts)
        firsts = np.cumsum(np.r_[0, sizes[:-1]])
        before, wanted = contexts([targets.take(p) for p in parts])
        logp = np.concatenate(
            [
                fitted.log_probabilities(before[s : s + BATCH], wanted[s : s + BATCH], tables)
                for s in range(0, len(wanted), BATCH)
            ]
        )
        dealt, at, leaves = words.leaves(ids)
        steps = within.log_probabilities(fitted.made(before.T.take(dealt, axis=1).T), at, leaves)
        logp += np.bincount(dealt[at], steps, len(ids))
        inside = ids >= 0
        # Counts inside the dictionary; a word that stands there with none is the end alone.
        seen = inside & (words.counts[np.maximum(ids, 0)] > 0)
        plain = np.where(inside, logs[np.maximum(ids, 0)], 0.0)
        # Of words outside the dictionary, their counts are still to come.
        shared = np.where(inside, 0.0, words.log_rest[np.where(inside, 0, ~ids)])
        rare = [Counter([t[i] for i in np.flatnonzero(p < 0)]) for t, p in zip(tokens, parts)]
        held = [len(r) for r in rare]
        row = np.arange(len(tokens))
        keys = part.column("key").to_pylist()
        # One row per text, under a token that no word equals, then one per word left to look up.
        own = [b" " + key + str(k).encode() for k, key in enumerate(keys)]
        whole = np.r_[row, np.repeat(row, held)]
        heads, none = len(row), int(sum(held))
        values = {
            "n_tokens": (sizes, pa.int64()),
            "n_known": (np.add.reduceat(seen, firsts, dtype=np.int64), pa.int64()),
            "base": (np.add.reduceat(plain, firsts), pa.float64()),
            "inner": (np.add.reduceat(-shared, firsts), pa.float64()),
            "model": (np.add.reduceat(logp, firsts) / np.log(10), pa.float64()),
        }
        columns = [part.column(c).take(pa.array(whole)) for c in ("id", "held_out", "key")]
        columns.append(pa.array([*own, *(w for r in rare for w in r)], pa.binary()))
        columns.append(pa.array([*[0] * heads, *(c for r in rare for c in r.values())], pa.int64()))
        for value, kind in values.values():
            columns.append(pa.concat_arrays([pa.array(value, kind), pa.nulls(none, kind)]))
        return pa.RecordBatch.from_arrays(columns, ["id", "held_out", "key", "token", "times", *values])

    rows = df.select(
        F.col(id_column).alias("id"),
        held_out.alias("held_out"),
        text_key(F.col(text_column)).alias("key"),
        F.col(text_column).alias("text"),
    ).mapInArrow(
        score,
        f"id {kind}, held_out boolean, key binary, token binary, times long, n_tokens long, "
        "n_known long, base double, inner double, model double",
    )
    least = int(dictionary.counts[1:].min()) if len(dictionary.words) > 1 else None
    rest = counts if least is None else counts.where(F.col("c") < least)
    met = rows.join(rest, "token", "left")
    log_count = F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 1)
    sums = met.groupBy("id", "held_out", "key").agg(
        F.count("n_tokens").alias("copies"),
        F.max("n_tokens").alias("n_tokens"),
        F.max("n_known").alias("in_dictionary"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("times"))).alias("looked_up"),
        F.max("base").alias("base"),
        F.max("inner").alias("inner"),
        F.max("model").alias("model"),
        F.sum(log_count).alias("rare"),
    )
    copies = F.col("copies")
    rare = F.coalesce("rare", F.lit(0.0)) / copies
    known_words = F.col("in_dictionary") + F.coalesce("looked_up", F.lit(0)) / copies
    base_score = F.col("base") + rare - F.col("n_tokens") * float(np.log10(n + v + 1))
    score_column = F.col("model") + F.col("inner") + rare
    out = sums.select(
        F.col("id").alias(id_column),
        "held_out",
        "n_tokens",
        known_words.cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        base_score.alias("base_score"),
        score_column.alias("score"),
        F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("_copy"),
    )
    return out.drop("_copy")
