"""An emotion model trained from seed words.

The word list names an emotion for the texts that it knows something of; these weak labels train
costs for all words, so that texts without a listed word get a label from the company that
their words keep. Sums over the texts are Spark's; the model has one integer per emotion and
bucket. How far its probabilities can be trusted is measured on texts it did not learn from.
"""

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwell.functions.emotion_words import (
    BUCKETS,
    COST_UNIT,
    word_costs,
    word_counter,
    words_only,
)
from moodwell.operators.once import compute_once
from moodwell.operators.scoring import Scorer, score_posts
from moodwell.schemas import EMOTIONS

#: Temperatures to choose from: words of a text do not speak independently, hence none below 1.
TEMPERATURES = [2.0**k for k in range(12)]


@dataclass(frozen=True)
class EmotionModel:
    """Emotions with the cost of each as such and of each bucket; under a megabyte."""

    labels: list[str]
    priors: list[int]
    costs: list[list[int]]
    temperature: float = 1.0


def weak_labels(df: DataFrame, text_col: str, scorer: Scorer | None = None) -> DataFrame:
    """The texts for which one emotion leads, as ``label``, by the word list or another scorer."""
    scored = score_posts(df.select(F.col(text_col).alias("_text")), scorer, "_text")
    leading = F.size(F.filter(F.array(*EMOTIONS), lambda score: score == F.col("confidence")))
    clear = scored.where((leading == 1) & ~F.col("scoring_failed") & F.col("_text").isNotNull())
    return clear.select(F.col("emotion_label").alias("label"), words_only(F.col("_text")).alias("words"))


def emotion_profile(labelled: DataFrame) -> DataFrame:
    """``label, prior, costs`` from ``label, words``: ``-1000 ln`` of smoothed shares, as integers.

    Each task sends at most BUCKETS rows per label to the shuffle.
    """
    counted = labelled.mapInPandas(word_counter(), "label string, bucket int, n long")
    per_label = counted.groupBy("label", "bucket").agg(F.sum("n").alias("n")).groupBy("label").agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("bucket", "n")).alias("seen")
    )
    texts = labelled.groupBy("label").agg(F.count("*").alias("texts"))
    share = F.col("texts") / texts.agg(F.sum("texts")).scalar()
    buckets = F.sequence(F.lit(0), F.lit(BUCKETS - 1))
    unseen = F.transform(
        F.array_except(buckets, F.transform("seen", lambda s: s["bucket"])),
        lambda bucket: F.struct(bucket.alias("bucket"), F.lit(0).cast("long").alias("n")),
    )

    def cost(part: Column) -> Column:
        return F.round(-COST_UNIT * F.ln(part)).cast("int")

    return per_label.join(F.broadcast(texts), "label").select(
        "label",
        cost(share).alias("prior"),
        F.transform(
            F.sort_array(F.concat("seen", unseen)),
            lambda s: cost((s["n"] + 1) / (F.col("total") + BUCKETS)),
        ).alias("costs"),
    )


def load_emotions(profile: DataFrame) -> EmotionModel:
    """Fetch a trained profile: a row of fixed size per emotion. An action."""
    rows = {r.label: r for r in profile.collect()}
    labels = [e for e in EMOTIONS if e in rows]
    return EmotionModel(labels, [rows[e].prior for e in labels], [rows[e].costs for e in labels])


def with_costs(df: DataFrame, model: EmotionModel, words_col: str, out: str) -> DataFrame:
    """Add the cost of each of the model's labels, in their order."""
    sums = word_costs(model.costs)(F.col(words_col))
    priors = F.array(*[F.lit(p).cast("long") for p in model.priors])
    return compute_once(df.withColumn(out, F.zip_with(sums, priors, lambda a, b: a + b)), out)


def cheapest(costs: Column, labels: list[str]) -> Column:
    """The label of least cost, the first of these in the model's order."""
    names = F.array(*[F.lit(label) for label in labels])
    return F.get(names, (F.array_position(costs, F.array_min(costs)) - 1).cast("int"))


def _weights(costs: Column, temperature: float) -> Column:
    return F.transform(costs, lambda c: F.exp((F.array_min(costs) - c) / (COST_UNIT * temperature)))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def calibrated(model: EmotionModel, labelled: DataFrame) -> EmotionModel:
    """The model with the temperature that makes the labels of other texts most likely. An action."""
    at = F.array_position(F.array(*[F.lit(e) for e in model.labels]), F.col("label"))
    rows = with_costs(labelled.where(F.col("label").isin(model.labels)), model, "words", "_costs")
    own = (F.get("_costs", (at - 1).cast("int")) - F.array_min("_costs")) / COST_UNIT
    losses = [
        F.sum(own / t + F.ln(_sum(_weights(F.col("_costs"), t)))).alias(f"loss{k}")
        for k, t in enumerate(TEMPERATURES)
    ]
    found = rows.agg(*losses).first()
    known = [math.inf if loss is None else loss for loss in found]
    return replace(model, temperature=TEMPERATURES[known.index(min(known))])


def trained_scorer(model: EmotionModel) -> Scorer:
    """A scorer with the model's probabilities; a text without a word gets those of any text."""
    score_words = word_costs(model.costs)
    priors = F.array(*[F.lit(p).cast("long") for p in model.priors])
    names = F.array(*[F.lit(label) for label in model.labels])

    def score(text: Column) -> Column:
        costs = F.zip_with(score_words(words_only(text)), priors, lambda a, b: a + b)

        def shares(c: Column) -> Column:
            weights = _weights(c, model.temperature)
            return F.zip_with(names, weights, lambda name, w: F.struct(name.alias("label"), (w / _sum(weights)).alias("score")))

        # One-element array: the costs are found once and read several times.
        return F.get(F.transform(F.array(costs), lambda c: F.when(c.isNotNull(), shares(c))), F.lit(0))

    return score


def learn_emotions(
    df: DataFrame, text_col: str, held_out: Column, scorer: Scorer | None = None
) -> EmotionModel:
    """A model trained on the texts that are not held out and calibrated on the others. Runs jobs."""
    model = load_emotions(emotion_profile(weak_labels(df.where(~held_out), text_col, scorer)))
    return calibrated(model, weak_labels(df.where(held_out), text_col, scorer))
