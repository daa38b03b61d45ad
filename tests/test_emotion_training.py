"""The trained emotion model against loops over words, and on texts without a seed word."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from moodwell.functions.emotion_words import BASE, BUCKETS, PLACES
from moodwell.operators.emotion_training import (
    TEMPERATURES,
    calibrated,
    emotion_profile,
    learn_emotions,
    load_emotions,
    trained_scorer,
    weak_labels,
    with_costs,
)
from moodwell.operators.scoring import score_posts
from moodwell.schemas import EMOTIONS


def buckets_of(text):
    words = re.findall(r"\w+", text.lower())
    return [sum(ord(c) * pow(BASE, i % PLACES, BUCKETS) for i, c in enumerate(w)) % BUCKETS for w in words]


ROWS = [
    ("joy", "happy cats, Happy_cats 12"), ("joy", "so glad"), ("anger", "rage! é" + "x" * 200), ("neutral", ""),
    ("neutral", " . "), ("neutral", "a cat\na cat"),
]


def test_costs_against_a_loop(spark):
    labelled = spark.createDataFrame(ROWS, "label string, text string")
    words = labelled.select("label", F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}_]+", " ").alias("words"))
    model = load_emotions(emotion_profile(words.repartition(3)))
    counts, texts = Counter(), Counter(label for label, _ in ROWS)
    for label, text in ROWS:
        counts.update((label, b) for b in buckets_of(text))
    assert model.labels == ["joy", "anger", "neutral"]
    for label, prior, costs in zip(model.labels, model.priors, model.costs):
        total = sum(n for (l, _), n in counts.items() if l == label)
        assert prior == round(-1000 * math.log(texts[label] / len(ROWS)))
        want = [round(-1000 * math.log((counts[label, b] + 1) / (total + BUCKETS))) for b in range(BUCKETS)]
        assert costs == want
    rows = with_costs(words.withColumn("at", F.monotonically_increasing_id()), model, "words", "costs").collect()
    for row in rows:
        found = buckets_of(row.words)
        assert row.costs == [p + sum(c[b] for b in found) for p, c in zip(model.priors, model.costs)]


def test_weak_labels(spark):
    texts = ["happy day", "happy but sad", "no idea", "", None, "HAPPY glad sad"]
    found = weak_labels(spark.createDataFrame([(t,) for t in texts], "text string"), "text").collect()
    want = [("joy", "happy day"), ("neutral", "no idea"), ("neutral", ""), ("joy", "happy glad sad")]
    assert sorted(map(tuple, found)) == sorted(want)


def made_up(rng, n):
    """Each emotion has words of its own besides the listed one, which some of its texts lack."""
    topics = {"joy": ("happy", "sun beach picnic song"), "sadness": ("sad", "rain grey alone bench")}
    for i in range(n):
        emotion, (seed, own) = rng.choice(list(topics.items()))
        words = rng.choices(own.split(), k=4) + rng.choices("the a we went to it was".split(), k=rng.randint(2, 12))
        listed = rng.random() < 0.8
        rng.shuffle(words)
        yield i, emotion, listed, " ".join(([seed] if listed else []) + words)


def test_company_of_words(spark):
    rows = list(made_up(random.Random(3), 1500))
    texts = spark.createDataFrame(rows, "id int, emotion string, listed boolean, text string")
    model = learn_emotions(texts.where("listed"), "text", F.col("id") % 5 == 4)
    assert model.temperature in TEMPERATURES
    told = score_posts(texts.where("NOT listed"), trained_scorer(model), "text")
    right = told.agg(F.avg((F.col("emotion") == F.col("emotion_label")).cast("int"))).first()[0]
    assert right > 0.95
    row = told.first()
    assert abs(sum(row[e] for e in EMOTIONS) - 1) < 0.001 and not row.scoring_failed
    empty = score_posts(texts.limit(1).select(F.lit("!?").alias("text")), trained_scorer(model), "text").first()
    assert abs(empty.joy - math.exp(-model.priors[0] / 1000 / model.temperature) / sum(
        math.exp(-p / 1000 / model.temperature) for p in model.priors)) < 0.001


def test_temperature_against_a_loop(spark):
    rows = list(made_up(random.Random(8), 400))
    rng = random.Random(9)
    # A third of the labels are wrong: the model must not be too sure of itself.
    labelled = spark.createDataFrame(
        [(rng.choice(["joy", "sadness"]) if rng.random() < 0.6 else e, t) for _, e, _, t in rows],
        "label string, words string",
    )
    model = load_emotions(emotion_profile(labelled))
    found = calibrated(model, labelled)

    def loss(t):
        total = 0.0
        for label, words in labelled.collect():
            costs = [p + sum(c[b] for b in buckets_of(words)) for p, c in zip(model.priors, model.costs)]
            own = costs[model.labels.index(label)]
            total += math.log(sum(math.exp((own - c) / 1000 / t) for c in costs))
        return total

    assert found.temperature == min(TEMPERATURES, key=loss) > 1
