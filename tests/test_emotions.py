import re

import pytest
from pyspark.sql import functions as F

from moodwell.functions.emotions import SCORES, default_lexicon, lexicon_scorer, model_scorer
from moodwell.operators.scoring import (
    enrich_stage,
    label_scores,
    score_posts,
    to_enriched,
    unanalyzed,
)
from moodwell.schemas import EMOTIONS


def labelled(spark, scores):
    df = spark.createDataFrame([(scores,)], f"scores {SCORES}")
    return label_scores(df).first()


@pytest.mark.parametrize(
    "scores, label, confidence, parts",
    [
        ([("joy", 0.9), ("anger", 0.1)], "joy", 0.9, {"joy": 0.9, "anger": 0.1}),
        ([("fear", 0.4), ("anger", 0.4), ("neutral", 0.2)], "anger", 0.4, {"fear": 0.4}),
        ([("JOY", 0.7), ("unknown", 0.9)], "joy", 0.7, {"neutral": 0.0}),
        ([("joy", 0.2), ("Joy", 0.123456)], "joy", 0.1235, {}),
        ([], "joy", 0.0, {e: 0.0 for e in EMOTIONS}),
        (None, "neutral", 1.0, {"neutral": 1.0, "joy": 0.0}),
    ],
)
def test_labels(spark, scores, label, confidence, parts):
    row = labelled(spark, scores)
    assert (row.emotion_label, row.confidence) == (label, confidence)
    for emotion, value in parts.items():
        assert row[emotion] == value


def test_lexicon(spark):
    texts = [
        ("I am happy, so HAPPY and angry!",),
        ("_angry_face_ rage and fear of joy",),
        ("so_crying_face_ and this_loudly_crying_face_",),
        ("nothing here",),
        ("",),
        (None,),
        ("   ",),
    ]
    got = score_posts(spark.createDataFrame(texts, "cleaned_text string")).collect()
    assert (got[0].emotion_label, got[0].joy, got[0].anger) == ("joy", 0.6667, 0.3333)
    assert (got[1].emotion_label, got[1].confidence) == ("anger", 0.5)
    assert (got[2].emotion_label, got[2].confidence) == ("sadness", 1.0)
    assert [r.emotion_label for r in got[3:]] == ["neutral"] * 4
    assert not any(r.scoring_failed for r in got)
    assert set(default_lexicon()) == set(EMOTIONS) - {"neutral"}


def test_own_lexicon(spark):
    df = spark.createDataFrame([("rain rain sun",)], "cleaned_text string")
    row = score_posts(df, lexicon_scorer({"sadness": ["rain"], "joy": ["sun"]})).first()
    assert (row.emotion_label, row.sadness) == ("sadness", 0.6667)


def test_lists_are_searched_where_there_may_be_one(spark):
    """Names of symbols where there is an underscore, words as long as the lists' shortest; the scores
    are those of all tokens taken apart."""
    lexicon = {"joy": ["joy", "_a_", "_a_b"], "fear": ["_a", "scared", "ab_c"], "anger": ["été", "a.b"]}
    texts = ["joyful joy JOY_a_", "x_a_b y_a scared_a_joy", "ab ab_c été_a_ÉTÉ a.b", "__a__ _ _a_a_b_", "jo y", "", "_a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    known = {w for words in lexicon.values() for w in words}
    symbols = "|".join(re.escape(w) for w in sorted(known) if w.startswith("_"))
    for row in df.select("t", lexicon_scorer(lexicon)(F.col("t")).alias("s")).collect():
        tokens = re.findall(r"\w+", re.sub(f"({symbols})", r" \1", row.t.lower()))
        hits = [t for t in tokens if t in known]
        want = [(e, sum(h in w for h in hits) / len(hits)) for e, w in lexicon.items()] if hits else [("neutral", 1.0)]
        assert [(x.label, x.score) for x in row.s] == want, row.t
    plan = df.select(lexicon_scorer()(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "(_(?:" in plan and "_]{3,}" in plan


def test_model_adapter(spark):
    def load():
        def model(texts):
            assert len(texts) <= 4
            if any("bad" in t for t in texts):
                raise ValueError("bad text")
            return [[{"label": "Fear", "score": len(t) / 100}] for t in texts]

        return model

    texts = [(i, "bad" if i == 5 else "x" * i) for i in range(20)] + [(20, None)]
    df = spark.createDataFrame(texts, "id int, cleaned_text string")
    got = {r.id: r for r in score_posts(df, model_scorer(load, batch_size=4)).collect()}
    assert (got[7].emotion_label, got[7].confidence, got[7].scoring_failed) == ("fear", 0.07, False)
    assert (got[5].emotion_label, got[5].confidence, got[5].scoring_failed) == ("neutral", 1.0, True)
    assert (got[20].emotion_label, got[20].scoring_failed) == ("neutral", False)
    assert (got[0].emotion_label, got[0].scoring_failed) == ("neutral", False)


def test_stored_confidence_rounds_half_up(spark):
    df = spark.createDataFrame(
        [(1, "b", [("joy", 0.985)]), (2, "b", [("joy", 0.995)]), (3, "b", [("joy", 0.5)])],
        f"id long, batch_id string, scores {SCORES}",
    )
    rows = to_enriched(label_scores(df), F.lit("2024-01-01 00:00:00")).orderBy("id").collect()
    assert [str(r.confidence) for r in rows] == ["0.99", "1.00", "0.50"]
    assert rows[2].emotion_distribution_data.joy == 0.5
    assert rows[0].emotion_intensity == rows[0].confidence


def test_unanalyzed_and_stage(spark):
    cleaned = spark.createDataFrame(
        [(1, "a", "en", "I am happy"), (2, "a", "en", ""), (3, "a", "fr", "x"), (4, "b", "en", "sad")],
        "id long, batch_id string, language string, cleaned_text string",
    )
    enriched = spark.createDataFrame([(4, "b")], "cleaned_post_id long, batch_id string")
    moment = F.lit("2024-01-01 00:00:00")

    def keys(df):
        return sorted((r.id, r.batch_id) for r in df.collect())

    assert keys(unanalyzed(cleaned, enriched)) == [(1, "a"), (2, "a")]
    assert keys(unanalyzed(cleaned, enriched, lang=None)) == [(1, "a"), (2, "a"), (3, "a")]
    assert keys(unanalyzed(cleaned, enriched, "b")) == []
    assert keys(enrich_stage(cleaned, enriched, moment, skip_empty=True)) == [(1, "a")]
    assert keys(enrich_stage(cleaned, enriched, moment, limit=1)) == [(1, "a")]
    assert enrich_stage(cleaned, enriched, moment, limit=0).count() == 0
    rows = {r.id: r for r in enrich_stage(cleaned, enriched, moment).collect()}
    assert rows[2].emotion_label == "neutral" and float(rows[2].confidence) == 1.0


def test_scoring_adds_no_shuffle(spark):
    df = spark.createDataFrame([("x",)], "cleaned_text string")
    plan = score_posts(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "INSET" in plan


def test_filters_on_labels_do_not_repeat_the_scoring(spark):
    df = spark.createDataFrame([("x",)], "cleaned_text string")
    found = score_posts(df).where("emotion_label = 'joy' AND confidence > 0.5")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
