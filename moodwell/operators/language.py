"""Training and use of language profiles."""

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodwell.functions.language import (
    BUCKETS,
    DEFAULT_LANGUAGE,
    MAX_LANGUAGES,
    MIXED_FROM,
    PAIR_COUNTS,
    UNKNOWN,
    bucket_cost,
    language_costs,
    letters_only,
    pair_counter,
    pair_scorer,
    part_scorer,
    second_share,
)
from moodwell.operators.once import compute_once


@dataclass(frozen=True)
class LanguageModel:
    """Languages and their bucket costs: at most 3 MB for all two-letter codes.

    Text whose pairs cost more than ``limit`` on average is in no known language.
    """

    langs: list[str]
    costs: list[list[int]]
    limit: int | None = None


def pair_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, bucket, n``: each task sends at most BUCKETS rows per language to the shuffle."""
    return (
        df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
        .select(F.col(lang_col).alias("lang"), letters_only(F.col(text_col)).alias("letters"))
        .mapInPandas(pair_counter(), PAIR_COUNTS)
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def train_profile(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, costs``: one row per language with a cost for each of the BUCKETS buckets."""
    per_lang = (
        pair_counts(df, text_col, lang_col)
        .groupBy("lang")
        .agg(
            F.sum("n").alias("total"),
            F.collect_list(F.struct("bucket", "n")).alias("seen"),
        )
    )
    # Both lists end at BUCKETS entries, so one row per language holds them.
    unseen = F.transform(
        F.array_except(
            F.sequence(F.lit(0), F.lit(BUCKETS - 1)), F.transform("seen", lambda s: s["bucket"])
        ),
        lambda bucket: F.struct(bucket.alias("bucket"), F.lit(0).cast("bigint").alias("n")),
    )
    return per_lang.select(
        "lang",
        F.transform(
            F.sort_array(F.concat("seen", unseen)),
            lambda s: bucket_cost(s["n"], F.col("total")),
        ).alias("costs"),
    )


def load_model(profile: DataFrame) -> LanguageModel:
    """Fetch a trained profile: one row of fixed size per language. An action."""
    rows = profile.select("lang", "costs").limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: is it the right column?")
    rows.sort(key=lambda row: row.lang)
    return LanguageModel([r.lang for r in rows], [r.costs for r in rows])


def with_language_costs(
    df: DataFrame, model: LanguageModel, text_col: str, out: str = "language_costs"
) -> DataFrame:
    """Add the costs per language, most likely first: no join and no shuffle of the texts."""
    costs = pair_scorer(model.costs)(letters_only(F.col(text_col)))
    return compute_once(df.withColumn(out, language_costs(costs, model.langs)), out)


def _with_parts(df: DataFrame, model: LanguageModel, text_col: str) -> DataFrame:
    """Add ``_ranked`` (the costs, most likely first), ``_pairs`` and ``_other``."""
    found = compute_once(
        df.withColumn("_parts", part_scorer(model.costs)(letters_only(F.col(text_col)))), "_parts"
    )
    ranked = language_costs(F.col("_parts.costs"), model.langs)
    added = {"_ranked": ranked, "_pairs": F.col("_parts.pairs"), "_other": F.col("_parts.other")}
    return found.withColumns(added).drop("_parts")


def _best() -> Column:
    return F.get("_ranked", F.lit(0))


def with_limit(
    model: LanguageModel, texts: DataFrame, text_col: str = "text", kept: float = 0.995
) -> LanguageModel:
    """The model with the least limit that accepts this share of some texts in its languages, which
    should not be those that it learned from. An action."""
    costs = _with_parts(texts.select(text_col), model, text_col).where("_pairs > 0")
    each = costs.groupBy(F.floor(_best()["cost"] / F.col("_pairs")).alias("cost")).agg(F.count("*").alias("n"))
    # One row for each cost of a pair, some ten thousand at most, whatever the number of texts.
    up_to = F.sum("n").over(Window.orderBy("cost").rowsBetween(Window.unboundedPreceding, 0))
    every = F.sum("n").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    enough = each.withColumns({"up_to": up_to, "every": every}).where(F.col("up_to") >= kept * F.col("every"))
    return replace(model, limit=enough.agg(F.min("cost")).first()[0])


def detect_language(
    df: DataFrame,
    model: LanguageModel,
    text_col: str = "text",
    language_col: str = "language",
    mixed_col: str = "mixed_language",
) -> DataFrame:
    """Most likely language, and whether a second one is likely too: for the text as a whole, or
    for parts of it that make up as much of it.

    Text without a pair of letters counts as the default language, not mixed; text beyond
    the model's limit, if it has one, is in an unknown language.
    """
    language = F.coalesce(_best()["lang"], F.lit(DEFAULT_LANGUAGE))
    if model.limit is not None:
        foreign = F.floor(_best()["cost"] / F.col("_pairs")) > model.limit
        language = F.when(foreign, F.lit(UNKNOWN)).otherwise(language)
    mixed = (second_share(F.col("_ranked")) > MIXED_FROM) | (F.col("_other") > MIXED_FROM)
    return (
        _with_parts(df, model, text_col)
        .withColumns({language_col: language, mixed_col: F.coalesce(mixed, F.lit(False))})
        .drop("_ranked", "_pairs", "_other")
    )


def language_confusion(detected: DataFrame, lang_col: str = "lang") -> DataFrame:
    """Posts per pair of given and detected language."""
    return detected.groupBy(F.col(lang_col).alias("lang"), "language").agg(
        F.count("*").alias("posts")
    )
