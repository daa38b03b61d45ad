"""Emotion scores: the scorer contract, a word-list scorer and a model adapter.

A scorer is a function from a text column to a column of
``array<struct<label string, score double>>``, null where scoring failed. Blank
texts reach it as null.
"""

import re
import logging
import sys
import uuid
from collections.abc import Callable, Iterator
from functools import reduce
from types import ModuleType

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from moodwell.functions.chars import WORD
from moodwell.functions.symbols import EMOJI_NAMES
from moodwell.schemas import EMOTIONS

SCORES = "array<struct<label:string,score:double>>"

FACES = {
    "anger": "😠😡😤🤬",
    "joy": "😊😄😁😃🙂😀🥰😍❤💚💙💛💜💕💗💖🎉😂",
    "sadness": "😞😢😭😔🥺😿💔",
    "fear": "😨😟😰😱🫣",
    "surprise": "😲😮🤯😯",
    "disgust": "🤢🤮😒",
}

WORDS = {
    "joy": "amazing delighted excited glad good great happy hope joy love lovely wonderful",
    "anger": "angry annoyed furious frustrated frustrating hate mad outraged rage",
    "fear": "afraid anxious concerned fear fearful scared terrified worried",
    "disgust": "disgust disgusted disgusting gross nasty repulsive sick",
    "sadness": "cry depressed disappointed grief lonely sad sorrowful terrible upset",
    "surprise": "astonished shocked sudden surprise surprised surprising unexpected wow",
}


def default_lexicon() -> dict[str, list[str]]:
    """Words and emoji placeholders per emotion."""
    return {
        emotion: words.split() + sorted({f"_{EMOJI_NAMES[face]}_" for face in FACES[emotion]})
        for emotion, words in WORDS.items()
    }


def lexicon_scorer(lexicon: dict[str, list[str]] | None = None) -> Callable[[Column], Column]:
    """Share of each emotion among the words of a text that the lexicon knows.

    The lists are literals of the plan, so scoring adds no join and no shuffle.
    """
    lexicon = lexicon or default_lexicon()
    known = sorted({word for words in lexicon.values() for word in words})
    # Their underscore stands apart, so that Java tries the names only where there is one.
    symbols = "|".join(re.escape(word[1:]) for word in known if word.startswith("_"))
    # Shorter tokens are no words of the lists.
    shortest = max(1, min(map(len, known), default=1))

    def share(hits: Column, words: list[str]) -> Column:
        return F.array_size(F.filter(hits, lambda token: token.isin(words))) / F.array_size(hits)

    def scores(hits: Column) -> Column:
        return F.array(
            *[
                F.struct(F.lit(emotion).alias("label"), share(hits, words).alias("score"))
                for emotion, words in lexicon.items()
            ]
        )

    nothing = F.array(F.struct(F.lit("neutral").alias("label"), F.lit(1.0).alias("score")))

    def score(text: Column) -> Column:
        words = F.lower(text)
        if symbols:
            # A symbol written right after a word starts a token of its own.
            parted = F.regexp_replace(words, f"(_(?:{symbols}))", " $1")
            words = F.when(text.contains("_"), parted).otherwise(words)
        tokens = F.regexp_extract_all(words, F.lit(f"{WORD}{{{shortest},}}"), F.lit(0))
        hits = F.filter(tokens, lambda token: token.isin(known))
        # One-element array: the hits are found once and read several times.
        return F.get(
            F.transform(
                F.array(hits),
                lambda found: F.when(F.array_size(found) > 0, scores(found)).when(
                    F.array_size(found) == 0, nothing
                ),
            ),
            F.lit(0),
        )

    return score


def model_scorer(
    factory: Callable[[], Callable[[list[str]], list]], batch_size: int = 32
) -> Callable[[Column], Column]:
    """Adapter for a Python model, loaded once per worker process and fed in batches.

    ``factory()`` returns a function from a list of texts to one list of
    ``{"label", "score"}`` per text. If a batch fails, its texts are tried one by
    one, so that one bad text does not cost the others their scores; what fails is logged.
    """
    name = f"model-{uuid.uuid4().hex}"

    def run(model, texts: list[str]) -> list:
        try:
            results = list(model(texts))
            if len(results) == len(texts):
                return results
        except Exception:
            if len(texts) == 1:
                logging.getLogger("moodwell").exception("a text could not be scored")
                return [None]
        return [None] if len(texts) == 1 else [r for t in texts for r in run(model, [t])]

    @F.pandas_udf(SCORES)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # Kept by the worker process, which outlives its tasks.
        held = sys.modules.setdefault("_moodwell_models", ModuleType("_moodwell_models")).__dict__
        if name not in held:
            held[name] = factory()
        model = held[name]
        for batch in batches:
            results = pd.Series([None] * len(batch), dtype=object)
            places = [i for i, text in enumerate(batch) if text is not None]
            for start in range(0, len(places), batch_size):
                chunk = places[start : start + batch_size]
                for place, result in zip(chunk, run(model, [batch.iloc[i] for i in chunk])):
                    results[place] = result
            yield results

    return score


def normalize_scores(scores: Column) -> Column:
    """Struct of the seven emotions, four decimals.

    Labels ignore case, a repeated label counts with its last score, unknown
    labels are dropped and missing ones are 0.
    """

    def of(emotion: str) -> Column:
        matches = F.filter(scores, lambda s: F.lower(s["label"]) == emotion)
        score = F.try_element_at(matches, F.lit(-1))["score"]
        return F.coalesce(F.round(score, 4), F.lit(0.0)).alias(emotion)

    return F.struct(*[of(emotion) for emotion in EMOTIONS])


def neutral_scores() -> Column:
    return F.struct(*[F.lit(1.0 if e == "neutral" else 0.0).alias(e) for e in EMOTIONS])


def top_score(by_emotion: Column) -> Column:
    return F.greatest(*[by_emotion[e] for e in EMOTIONS])


def top_emotion(by_emotion: Column) -> Column:
    """The emotion with the highest score, the first in order on a tie."""
    best = top_score(by_emotion)
    pick = reduce(
        lambda case, e: case.when(by_emotion[e] == best, e),
        EMOTIONS[1:-1],
        F.when(by_emotion[EMOTIONS[0]] == best, EMOTIONS[0]),
    )
    return pick.otherwise(EMOTIONS[-1])
